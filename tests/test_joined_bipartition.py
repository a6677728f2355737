"""Bipartition of texts whose vocabulary is too large for the packed form."""

from tessera.plans import text_cluster_queries as T

SF = "/root/testdata/sf0.001"


def test_joined_form_gives_the_packed_forms_branches(spark, monkeypatch):
    monkeypatch.setattr(T, "BISECT_RUNS", (71, 72))
    monkeypatch.setattr(T, "BISECT_ITER", 3)

    def found():
        return sorted((r["branch"], r["n"], None if r["heterogeneity_after_split"] is None else round(r["heterogeneity_after_split"], 6))
                      for r in T.bipartition_text(spark, SF).collect())
    packed = found()
    monkeypatch.setattr(T.PK, "fits", lambda words, k: False)
    assert found() == packed and len(packed) == 7
