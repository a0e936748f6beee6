"""Queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import codes, ctw, jaccard, langid, mixing, packing, pieces, pii, quality, toolcalls, topk, trie, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.query,
    "op2_langid": langid.query,
    "op3_toolcalls": toolcalls.query,
    "op4_packing": packing.query,
    "op5_jaccard": jaccard.query,
    "op6_mixing": mixing.query,
    "op7_ctw": ctw.query,
    "op8_quality": quality.query,
    "op9_warc": warc.query,
    "op10_topk": topk.query,
    "op11_trie": trie.query,
    "op12_pieces": pieces.query,
    "op13_codes": codes.query,
}

SQL: dict[str, str] = {"op6_mixing": mixing.SQL, "op9_warc": warc.SQL, "op10_topk": topk.SQL, "op11_trie": trie.SQL, "op13_codes": codes.SQL}
