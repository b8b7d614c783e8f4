"""Quality rules: one pass that measures, a ledger of failure bits, policies as masks over it.

``measure`` evaluates every rule of a rule set once per text and returns the measurements and a
``failed`` bitmask (bit i: rule i failed). A policy is a versioned mask: a text is kept if no bit of
the mask is set. Policies can be applied and varied later without touching the texts, and
``ablation`` answers from grouped bitmasks what each rule adds.

Defined results: a null text has no words; ids may be null or repeat (one row per input row);
extra columns are ignored by ``measure`` and kept by ``keep_rows``; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import chunks, flat_words, give_back, plain

#: Words of a repeat window.
WINDOW = 5
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_short_lines", "n_letter_words")


@dataclass(frozen=True)
class Rule:
    """Fails where ``left > right`` (SQL over the measurements); both sides are whole numbers."""

    name: str
    fails: str


#: The order is the bit order; a rule may be added at the end, never moved or reused.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 14 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("dup_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("few_letters", "100 * n_letter_words < 70 * n_words"),
    Rule("many_words", "n_words > 1000000"),
)


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        place = {rule.name: i for i, rule in enumerate(rules)}
        if unknown := [name for name in self.rules if name not in place]:
            raise ValueError(f"policy {self.name} v{self.version} names unknown rules: {unknown}")
        return sum(1 << place[name] for name in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy(
    "standard", 1, ("few_words", "repeated_windows", "short_words", "long_words", "many_symbols", "dup_lines", "few_letters")
)
POLICIES = (BASE, STANDARD)


def _repeat_words(owner: np.ndarray, codes: np.ndarray, n_docs: int) -> np.ndarray:
    """Words covered by windows of WINDOW words that come more than once within their text."""
    n = len(codes) - WINDOW + 1
    if n <= 0:
        return np.zeros(n_docs, np.int64)
    start = np.flatnonzero(owner[:n] == owner[WINDOW - 1:])
    # Equal numbers for equal windows, exactly: number pairs of (number so far, next word) anew.
    number = owner[start]
    for k in range(WINDOW):
        pair = number * (int(codes.max()) + 1) + codes[start + k]
        number = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        if k >= 1:  # a window whose beginning is alone cannot repeat
            several = np.bincount(number)[number] > 1
            start, number = start[several], number[several]
        if not len(start):
            return np.zeros(n_docs, np.int64)
    covered = np.zeros(len(codes) + 1, np.int64)
    np.add.at(covered, start, 1)
    np.add.at(covered, start + WINDOW, -1)
    return np.bincount(owner[np.cumsum(covered[:-1]) > 0], minlength=n_docs).astype(np.int64)


def _measure_values(texts: pa.Array) -> dict[str, np.ndarray]:
    n = len(texts)
    values = pc.fill_null(texts.cast(pa.large_string()), "")
    count = lambda owner, weight=None: np.bincount(owner, weights=weight, minlength=n).astype(np.int64)
    owner, words = flat_words(values)
    codes = words.dictionary_encode()
    kinds = codes.dictionary
    ids = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.utf8_length(kinds).to_numpy(zero_copy_only=False).astype(np.int64)
    letters = pc.match_substring_regex(kinds, r"\p{L}").to_numpy(zero_copy_only=False)
    symbols = pc.count_substring_regex(values, "[" + SYMBOLS + "]").to_numpy(zero_copy_only=False).astype(np.int64)

    lines = pc.split_pattern(values, "\n")
    line_owner = pc.list_parent_indices(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    line_values = pc.list_flatten(lines)
    filled = pc.match_substring_regex(line_values, "[^ \\t\\n\\v\\f\\r]").to_numpy(zero_copy_only=False)
    line_owner, line_values = line_owner[filled], line_values.filter(pa.array(filled))
    line_ids = line_values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = line_owner * (int(line_ids.max()) + 1 if len(line_ids) else 1) + line_ids
    kept = np.zeros(len(key), bool)
    kept[np.unique(key, return_index=True)[1]] = True
    short = pc.utf8_length(line_values).to_numpy(zero_copy_only=False) < 20
    return {
        "n_words": count(owner),
        "word_chars": count(owner, size[ids]) if len(ids) else np.zeros(n, np.int64),
        "n_symbols": symbols,
        "n_dup_lines": count(line_owner[~kept]),
        "n_repeat_words": _repeat_words(owner, ids, n),
        "n_lines": count(line_owner),
        "n_short_lines": count(line_owner[short]),
        "n_letter_words": count(owner[letters[ids]]) if len(ids) else np.zeros(n, np.int64),
    }


def _measured(texts: pa.Array) -> dict[str, np.ndarray]:
    parts = [_measure_values(chunk) for chunk in chunks(texts)]
    give_back()
    return {name: np.concatenate([part[name] for part in parts]) if parts else np.zeros(0, np.int64) for name in MEASURES}


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the measurements and ``failed`` (long, a bit per rule) of every row of ``docs``."""
    if len(rules) > 63:
        raise ValueError("a ledger has 63 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _measured(plain(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [plain(batch.column("doc_id")), *(pa.array(found[name]) for name in MEASURES)], names=["doc_id", *MEASURES]
            )

    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    measured = slim.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{name} long" for name in MEASURES))
    return measured.withColumn("failed", F.expr(ledger_sql(rules)))


def ledger_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The failure bits as an expression over the measurements."""
    bits = [f"IF({rule.fails}, CAST({1 << i} AS BIGINT), CAST(0 AS BIGINT))" for i, rule in enumerate(rules)]
    return " | ".join(bits)


def apply_policies(ledger: DataFrame, policies: tuple[Policy, ...] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger with a boolean per policy: ``kept_<name>_v<version>``."""
    kept = {f"kept_{p.name}_v{p.version}": F.col("failed").bitwiseAND(F.lit(p.mask(rules)).cast("long")) == 0 for p in policies}
    return ledger.withColumns(kept)


def ablation(ledger: DataFrame, policy: Policy = STANDARD, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: texts that fail it, that fail nothing else (so leaving the rule out
    would keep them), and that are kept with the rule and without it. Bitmasks are grouped first, so
    at most 2**rules rows go on, however many texts there are."""
    masks = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("long")).alias("bits")).agg(
        F.count("*").alias("texts")
    )
    place = {rule.name: i for i, rule in enumerate(rules)}
    bit = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(1 << place[name]).cast("long").alias("bit")) for name in policy.rules)))
    tall = masks.select("bits", "texts", bit.alias("r")).select("bits", "texts", "r.rule", "r.bit")
    when = lambda condition: F.sum(F.when(condition, F.col("texts")).otherwise(0)).alias
    return tall.groupBy("rule").agg(
        when(F.col("bits").bitwiseAND(F.col("bit")) != 0)("fail"),
        when(F.col("bits") == F.col("bit"))("fail_only_this"),
        when(F.col("bits") == 0)("kept_with"),
        when((F.col("bits") == 0) | (F.col("bits") == F.col("bit")))("kept_without"),
    )


def keep_rows(docs: DataFrame, policy: Policy = STANDARD, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with all their columns, in one pass without a shuffle."""
    kind = ", ".join(f"{name}: long" for name in MEASURES)

    @F.arrow_udf(f"struct<{kind}>")
    def run(texts: pa.Array) -> pa.Array:
        found = _measured(plain(texts))
        return pa.StructArray.from_arrays([pa.array(found[name]) for name in MEASURES], names=list(MEASURES))

    own = "measured"
    while own in docs.columns:
        own += "_"
    bits = re.sub(r"\b(" + "|".join(MEASURES) + r")\b", rf"`{own}`.\1", ledger_sql(rules))
    kept = docs.withColumn(own, run(F.col("text").cast("string"))).where(F.expr(bits).bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0)
    return kept.select(*(F.col(f"`{name}`") for name in docs.columns))
