"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm import clusters, decontaminate, language, licenses, manifest, minhash, mixing, neighbours, privacy, ranking, sharding, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": minhash.op1_minhash_dedup,
    "op2_two_pass_shuffle": sharding.op2_two_pass_shuffle,
    "op3_pigeonhole_decontaminate": decontaminate.op3_pigeonhole_decontaminate,
    "op4_pmi_sanitise": privacy.op4_pmi_sanitise,
    "op5_ppm_language": language.op5_ppm_language,
    "op6_golden_mix": mixing.op6_golden_mix,
    "op7_cnn_toxicity": toxicity.op7_cnn_toxicity,
    "op8_sharded_warc": warc.op8_sharded_warc,
    "op9_posting_lists": neighbours.op9_posting_lists,
    "op10_diagonal_licenses": licenses.op10_diagonal_licenses,
    "op11_pairwise_quality": ranking.op11_pairwise_quality,
    "op12_merkle_manifest": manifest.op12_merkle_manifest,
    "op13_vantage_clusters": clusters.op13_vantage_clusters,
}

ORACLES: dict[str, str] = {
    "op1_minhash_dedup": minhash.ORACLE,
    "op6_golden_mix": mixing.ORACLE,
    "op8_sharded_warc": warc.ORACLE,
    "op10_diagonal_licenses": licenses.ORACLE,
    "op12_merkle_manifest": manifest.ORACLE,
    "op13_vantage_clusters": clusters.ORACLE,
}
