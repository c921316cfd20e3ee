"""Queries of this subpackage by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxlake.llm.decontamination import op1_seeded_alignment
from voxlake.llm.fixity import OP2_SQL, op2_merkle_fixity
from voxlake.llm.licenses import OP6_SQL, op6_license_digests
from voxlake.llm.line_rules import OP8_SQL, op8_line_frequency
from voxlake.llm.mixing import OP4_SQL, op4_hash_threshold_mix
from voxlake.llm.neardup import OP7_SQL, op7_odd_sketch
from voxlake.llm.ngram_lm import op9_elias_fano_lm
from voxlake.llm.perspectives import OP10_SQL, op10_perspective_rotation
from voxlake.llm.sharding import op5_virtual_slots
from voxlake.llm.toxicity import op3_compression_distance


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_seeded_alignment": op1_seeded_alignment,
        "op2_merkle_fixity": op2_merkle_fixity,
        "op3_compression_distance": op3_compression_distance,
        "op4_hash_threshold_mix": op4_hash_threshold_mix,
        "op5_virtual_slots": op5_virtual_slots,
        "op6_license_digests": op6_license_digests,
        "op7_odd_sketch": op7_odd_sketch,
        "op8_line_frequency": op8_line_frequency,
        "op9_elias_fano_lm": op9_elias_fano_lm,
        "op10_perspective_rotation": op10_perspective_rotation,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_merkle_fixity": OP2_SQL,
        "op4_hash_threshold_mix": OP4_SQL,
        "op6_license_digests": OP6_SQL,
        "op7_odd_sketch": OP7_SQL,
        "op8_line_frequency": OP8_SQL,
        "op10_perspective_rotation": OP10_SQL,
    }
