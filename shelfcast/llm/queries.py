"""The registered query of each operator, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import audit, chat, collision, importance, langid, mixing, negatives, packfile, packing, phrases, prefixes, repeats, simhash

_QUERIES = (simhash.op1_simhash_vptree, langid.op2_language_id, chat.op3_chat_format, repeats.op4_repeats, packfile.op5_packed_ids, packing.op6_packing,
            phrases.op7_phrase_fingerprints, mixing.op8_mixing, importance.op9_importance, collision.op10_collision_ann,
            audit.op11_filter_audit, prefixes.op12_prefix_counts, negatives.op13_hard_negatives)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(chat.SQL) | {"op11_filter_audit": audit.SQL, "op13_hard_negatives": negatives.SQL}
