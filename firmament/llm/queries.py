"""The queries of this subpackage, and SQL for those that a second engine can check."""

from __future__ import annotations

import corpus_pipeline
from firmament.llm import (collocations, decontamination, exact_dedup, language_id, order_minhash, packing, sharding, simhash, spelling, substring_dedup, toxicity,
                           url_filter, warc)

QUERIES = {
    "op1_decontamination": decontamination.op1_decontamination,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_ring_shards": sharding.op3_ring_shards,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_packing": packing.op5_packing,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_simhash": simhash.op7_simhash,
    "op8_warc": warc.op8_warc,
    "op9_language_id": language_id.op9_language_id,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_collocations": collocations.op11_collocations,
    "op12_order_minhash": order_minhash.op12_order_minhash,
    "op13_spelling": spelling.op13_spelling,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op6_exact_dedup": exact_dedup.SQL,
    "op8_warc": warc.SQL,
    "op11_collocations": collocations.SQL,
}
