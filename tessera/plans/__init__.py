"""Registered queries: each module registers (spark query, DuckDB oracle) pairs."""

from tessera.plans import relational_queries  # noqa: F401
from tessera.plans import text_queries  # noqa: F401
from tessera.plans import similarity_queries  # noqa: F401
from tessera.plans import regression_queries  # noqa: F401
from tessera.plans import classification_queries  # noqa: F401
from tessera.plans import tree_queries  # noqa: F401
from tessera.plans import cluster_queries  # noqa: F401
from tessera.plans import recommend_queries  # noqa: F401
from tessera.plans import topic_queries  # noqa: F401
from tessera.plans import model_queries  # noqa: F401
from tessera.plans import text_cluster_queries  # noqa: F401
from tessera.plans import search_queries  # noqa: F401
from tessera.plans import word_logistic_queries  # noqa: F401
from tessera.plans import text_lsh_queries  # noqa: F401
from tessera.plans import io_queries  # noqa: F401
