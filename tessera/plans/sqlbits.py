"""Reusable DuckDB SQL fragments for oracle texts (independent of the Spark code)."""

WS = r"[ \t\r\n]+"


def word_counts_sql(table: str, id_col: str, text_col: str = "text", lower: bool = True) -> str:
    t = f"lower({text_col})" if lower else text_col
    return (f"SELECT {id_col}, w AS word, count(*)::BIGINT AS count FROM "
            f"(SELECT {id_col}, unnest(string_split_regex({t}, '{WS}')) AS w FROM {table}) "
            f"WHERE w <> '' GROUP BY {id_col}, w")


def idf_sql(counts_cte: str, corpus_table: str) -> str:
    return (f"SELECT word, ln((SELECT count(*) FROM {corpus_table})::DOUBLE / count(*)) AS idf "
            f"FROM {counts_cte} GROUP BY word "
            f"HAVING count(*) < (SELECT count(*) FROM {corpus_table})")


# ------------------------------------------------------------------ small linear systems in SQL

def det_sql(M: list[list[str]]) -> str:
    n = len(M)
    if n == 1:
        return f"({M[0][0]})"
    if n == 2:
        return f"(({M[0][0]}) * ({M[1][1]}) - ({M[0][1]}) * ({M[1][0]}))"
    terms = []
    for j in range(n):
        minor = [[M[r][c] for c in range(n) if c != j] for r in range(1, n)]
        sign = "+" if j % 2 == 0 else "-"
        terms.append(f"{sign} ({M[0][j]}) * {det_sql(minor)}")
    return "(" + " ".join(terms) + ")"


def cramer_sql(M: list[list[str]], b: list[str]) -> list[str]:
    D = det_sql(M)
    n = len(M)
    out = []
    for i in range(n):
        Mi = [[b[r] if c == i else M[r][c] for c in range(n)] for r in range(n)]
        out.append(f"({det_sql(Mi)} / {D})")
    return out


def ols_ctes(src: str, xs: list[str], y: str, l2: str = "0", group: list[str] | None = None,
             prefix: str = "ols") -> str:
    """CTEs ``{prefix}_s`` and ``{prefix}`` (columns: group..., b0, b1..bd): least squares with
    intercept (ridge when l2 > 0; intercept not penalised) by Cramer's rule on centred sums.
    ``src`` is a relation with columns xs, y (and the group columns)."""
    g = group or []
    gsel = "".join(f"{c}, " for c in g)
    gby = f" GROUP BY {', '.join(g)}" if g else ""
    d = len(xs)
    parts = [f"count(*)::DOUBLE AS n", f"avg({y}) AS my"]
    for i, x in enumerate(xs, 1):
        parts.append(f"avg({x}) AS m{i}")
        parts.append(f"covar_pop({x}, {y}) * count(*) AS c{i}y")
        for j, x2 in enumerate(xs, 1):
            if j >= i:
                parts.append(f"covar_pop({x}, {x2}) * count(*) AS c{i}_{j}")
    M = [[(f"c{min(i, j)}_{max(i, j)}" + (f" + ({l2})" if i == j else ""))
          for j in range(1, d + 1)] for i in range(1, d + 1)]
    bvec = [f"c{i}y" for i in range(1, d + 1)]
    sols = cramer_sql(M, bvec)
    bsel = ", ".join(f"{s} AS b{i}" for i, s in enumerate(sols, 1))
    msel = ", ".join(f"m{i}" for i in range(1, d + 1))
    b0 = "my - " + " - ".join(f"b{i} * m{i}" for i in range(1, d + 1))
    ws = ", ".join(f"b{i}" for i in range(1, d + 1))
    return (f"{prefix}_s AS (SELECT {gsel}{', '.join(parts)} FROM {src}{gby}),\n"
            f"{prefix}_b AS (SELECT {gsel}{bsel}, {msel}, my FROM {prefix}_s),\n"
            f"{prefix} AS (SELECT {gsel}{b0} AS b0, {ws} FROM {prefix}_b)")
