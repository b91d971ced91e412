"""The training-data queries by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import OP1_SQL, op1_decontaminate
from .embeddings import OP4_SQL, op4_embedding_dedup
from .katz import op7_katz
from .langid import op9_langid
from .mixing import op8_mixing
from .negatives import OP11_SQL, op11_hard_negatives
from .packing import op13_packing
from .rollup import OP3_SQL, op3_token_rollup
from .simhash import op6_simhash
from .spelling import op12_spelling
from .token_ids import op2_token_ids
from .toxicity import op5_toxicity
from .warc import OP10_SQL, op10_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_decontaminate, op2_token_ids, op3_token_rollup, op4_embedding_dedup, op5_toxicity, op6_simhash, op7_katz, op8_mixing, op9_langid, op10_warc, op11_hard_negatives, op12_spelling, op13_packing)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": OP1_SQL, "op3_token_rollup": OP3_SQL, "op4_embedding_dedup": OP4_SQL, "op10_warc": OP10_SQL, "op11_hard_negatives": OP11_SQL}
