"""The queries of this subpackage and, where SQL can say the same, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from quarrystone.llm import oracles
from quarrystone.llm.collocations import op12_collocations
from quarrystone.llm.embedding_dedup import op10_embedding_dedup
from quarrystone.llm.kmeans import op13_centroids
from quarrystone.llm.language import op4_language
from quarrystone.llm.line_dedup import op9_line_dedup
from quarrystone.llm.ngram_join import op3_ngram_jaccard
from quarrystone.llm.packing import op5_packing
from quarrystone.llm.pieces import op7_pieces
from quarrystone.llm.pii import op1_pii_surrogates
from quarrystone.llm.quality import op8_quality
from quarrystone.llm.substring_dedup import op6_substring_dedup
from quarrystone.llm.token_files import op2_token_files
from quarrystone.llm.url_rules import op11_url_rules


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii_surrogates": op1_pii_surrogates,
        "op2_token_files": op2_token_files,
        "op3_ngram_jaccard": op3_ngram_jaccard,
        "op4_language": op4_language,
        "op5_packing": op5_packing,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_pieces": op7_pieces,
        "op8_quality": op8_quality,
        "op9_line_dedup": op9_line_dedup,
        "op10_embedding_dedup": op10_embedding_dedup,
        "op11_url_rules": op11_url_rules,
        "op12_collocations": op12_collocations,
        "op13_centroids": op13_centroids,
        "pipeline": lambda spark, sf_dir: corpus_pipeline.run(spark, sf_dir),
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
