"""Registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from driftlog.llm.collocations import ORACLE_OP11, op11_phrase_collocations
from driftlog.llm.decontaminate import ORACLE_OP6, op6_benchmark_decontamination
from driftlog.llm.extendible_sharding import op4_extendible_sharding, oracle_op4
from driftlog.llm.hard_negatives import ORACLE_OP13, op13_hard_negatives
from driftlog.llm.line_dedup import op2_line_dedup
from driftlog.llm.packing import op7_kk_packing
from driftlog.llm.pitman_yor import op1_pitman_yor
from driftlog.llm.quality_ledger import ORACLE_OP5, op5_quality_ledger
from driftlog.llm.relative_lz import ORACLE_OP10, op10_relative_lz
from driftlog.llm.repair_ids import op9_repair_ids
from driftlog.llm.secret_scan import op12_secret_scan
from driftlog.llm.simhash_dedup import op8_simhash_dedup
from driftlog.llm.warc_normalise import ORACLE_OP3, op3_warc_normalise

QUERIES = {
    "op1_pitman_yor": op1_pitman_yor,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc_normalise": op3_warc_normalise,
    "op4_extendible_sharding": op4_extendible_sharding,
    "op5_quality_ledger": op5_quality_ledger,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_kk_packing": op7_kk_packing,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_repair_ids": op9_repair_ids,
    "op10_relative_lz": op10_relative_lz,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_secret_scan": op12_secret_scan,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op3_warc_normalise": ORACLE_OP3,
    "op4_extendible_sharding": oracle_op4(),
    "op5_quality_ledger": ORACLE_OP5,
    "op6_benchmark_decontamination": ORACLE_OP6,
    "op10_relative_lz": ORACLE_OP10,
    "op11_phrase_collocations": ORACLE_OP11,
    "op13_hard_negatives": ORACLE_OP13,
}
