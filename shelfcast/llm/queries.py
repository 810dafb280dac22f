"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from shelfcast.llm import ctw, decontaminate, knn_quality, lines, manifest, mixing, near_dups, phrases, pii, preference, quality_rules, resample, substrings
from shelfcast.llm.common import table

QUERIES = {
    "op1_pii": lambda spark, d: pii.op1(table(spark, d, "documents")),
    "op2_phrases": lambda spark, d: phrases.op2(table(spark, d, "documents")),
    "op3_near_dups": lambda spark, d: near_dups.op3(table(spark, d, "documents")),
    "op4_quality_rules": lambda spark, d: quality_rules.op4(table(spark, d, "documents")),
    "op5_preference": lambda spark, d: preference.op5(table(spark, d, "conversations")),
    "op6_mixing": lambda spark, d: mixing.op6(table(spark, d, "documents")),
    "op7_decontaminate": lambda spark, d: decontaminate.op7(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op8_knn_quality": lambda spark, d: knn_quality.op8(table(spark, d, "documents"), table(spark, d, "labels")),
    "op10_ctw": lambda spark, d: ctw.op10(table(spark, d, "documents")),
    "op9_line_dedup": lambda spark, d: lines.op9(table(spark, d, "pages")),
    "op11_resample": lambda spark, d: resample.op11(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op12_substrings": lambda spark, d: substrings.op12(table(spark, d, "documents")),
    "op13_manifest": lambda spark, d: manifest.op13(table(spark, d, "documents")),
}
ORACLE = {"op5_preference": preference.OP5_SQL, "op9_line_dedup": lines.OP9_SQL, "op11_resample": resample.OP11_SQL, "op13_manifest": manifest.OP13_SQL}
