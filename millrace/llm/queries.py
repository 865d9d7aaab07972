"""The registered queries of the corpus operators on the supplied tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import lines, minhash, mixing, packing, phrases, quality, spots, suffixes, tokens, transducer, vectors, whitening, wrappers


def _on(operator: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return operator(*[spark.read.parquet(os.path.join(folder, f"{t}.parquet")) for t in tables])

    return run


QUERIES = {
    "op1_minhash_near_dedup": _on(minhash.query, "documents"),
    "op2_suffix_dedup": _on(suffixes.query, "documents"),
    "op3_spot_fingerprints": _on(spots.query, "documents"),
    "op4_mixing": _on(mixing.query, "documents"),
    "op5_html_extraction": _on(wrappers.query, "pages"),
    "op6_embedding_near_dedup": _on(vectors.query, "embeddings"),
    "op7_packing": _on(packing.query, "documents"),
    "op8_line_dedup": _on(lines.query, "documents"),
    "op9_token_counts": _on(tokens.query, "documents"),
    "op10_quality": _on(quality.query, "documents", "labels"),
    "op11_whitening": _on(whitening.query, "embeddings"),
    "op12_bpe_transducer": _on(transducer.query, "documents"),
    "op13_phrase_collocations": _on(phrases.query, "documents"),
}
SQL = {"op8_line_dedup": lines.QUERY_SQL, "op13_phrase_collocations": phrases.QUERY_SQL}
