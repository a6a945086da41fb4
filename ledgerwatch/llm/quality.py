"""Quality rules with a bitmask ledger: every rule once, policies afterwards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.text import BLANK

#: Rules in the order of their bits: name, and the condition on the measurements that fails it.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "5 * n_symbols > n_words"),
    ("duplicate_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    ("capitals", "2 * n_capital_words > n_words"),
    ("exclamations", "2 * n_exclamations > n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 16 * n_words"),
    ("runs_of_a_word", "5 * n_stutters > n_words"),
    ("few_letters", "2 * n_letterless > n_words"),
)
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(BITS),
}


def mask_of(rules) -> int:
    return sum(BITS[r] for r in rules)


#: Filled by ``ledger`` besides the mask.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capital_words", "n_exclamations", "n_stutters", "n_letterless")


def _once(value: str, name: str, then: str) -> str:
    """SQL that computes ``value`` once and uses it as ``name`` in ``then`` (also inside lambdas)."""
    return f"transform(array({value}), {name} -> {then})[0]"


def _repeated_words(words: str, width: int = 5) -> str:
    """Words inside windows of ``width`` words that occur twice or more.

    Windows are compared by 64-bit hashes chained over their words. Only if some hash repeats are
    (hash, place) pairs sorted; each place whose hash has an equal neighbour covers ``width`` words, and
    what two covered windows share counts once. All steps are linear or a sort.
    """
    last = f"size({words}) - {width - 1}"
    hashes = _once(f"transform({words}, w -> xxhash64(w))", "h", f"transform(sequence(1, {last}), i -> xxhash64({', '.join(f'h[i + {k}]' for k in range(-1, width - 1))}))")
    twins = "filter(s, (x, i) -> get(s, i - 1).v = x.v OR get(s, i + 1).v = x.v)"
    places = f"array_sort(transform({_once('array_sort(transform(g, (x, i) -> struct(x AS v, i AS at)))', 's', twins)}, x -> x.at))"
    covered = _once(places, "p", f"aggregate(transform(p, (at, i) -> CAST(IF(i + 1 < size(p), least({width}, p[i + 1] - at), {width}) AS BIGINT)), 0L, (a, x) -> a + x)")
    return f"IF(size({words}) < {width + 1}, 0L, {_once(hashes, 'g', f'IF(size(array_distinct(g)) = size(g), 0L, {covered})')})"


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, then ``quality``: a struct of ``failures`` and the measurements.

    Every rule of ``RULES`` is evaluated once for each row; bit i of ``failures`` is set if rule i fails. Null
    and empty texts have no words and fail ``few_words``. The columns of ``docs`` keep their names and
    values, whatever they are called, but for one named ``quality``, which is replaced. Built-in
    functions only.
    """
    columns = [c for c in docs.columns if c != "quality"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("d"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.withColumn("w", F.expr(f"array_remove(split(t, '{BLANK}+'), '')".replace("\\", "\\\\")))
    lines = "filter(split(t, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    lists = F.expr(_once(lines, "l", "struct(CAST(size(l) AS BIGINT) AS n, CAST(size(l) - size(array_distinct(l)) AS BIGINT) AS d)"))
    found = F.struct(
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lists.alias("lines"),
        F.expr(_repeated_words("w")).alias("n_repeat_words"),
        F.regexp_count("t", F.lit(r"(?<!\S)\p{Lu}{2}[^\s\p{Ll}]*(?!\S)")).cast("long").alias("n_capital_words"),
        F.regexp_count("t", F.lit("!")).cast("long").alias("n_exclamations"),
        F.expr("CAST(size(filter(w, (x, i) -> x = get(w, i - 1))) AS BIGINT)").alias("n_stutters"),
        F.regexp_count("t", F.lit(r"(?<!\S)[^\s\p{L}]+(?!\S)")).cast("long").alias("n_letterless"),
    )
    # a generator of one row: filters on the measurements stay above it and don't compute them again
    measured = rows.select("d", F.inline(F.array(found))).select("*", F.col("lines.n").alias("n_lines"), F.col("lines.d").alias("n_dup_lines"))
    judged = measured.withColumn("failures", failure_bits())
    return judged.select("d.*", F.struct("failures", *MEASURES).alias("quality"))


def failure_bits() -> Column:
    bits = F.lit(0)
    for name, condition in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0)))
    return bits


def passes(policy: str, failures: str = "quality.failures") -> Column:
    """Whether a row passes a policy: none of its rules failed."""
    return F.col(failures).bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def keep_good(docs: DataFrame, policy: str = "v1", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass ``policy``, unchanged.

    Null and empty texts have no words and fail; ids are not looked at; repeated rows stay; an empty table stays
    empty. A column ``quality`` of the rows' own is kept; ``_own_quality`` is a reserved name.
    """
    judged = ledger(docs.withColumnRenamed("quality", "_own_quality"), text_col).where(passes(policy))
    return judged.drop("quality").withColumnRenamed("_own_quality", "quality")


def ablation(judged: DataFrame, policies: Mapping[str, tuple] = POLICIES) -> DataFrame:
    """For each policy and rule of it: rows it fails, rows that only it rejects, rows kept without it.

    Rows are first counted by failure bits (at most 2^rules lines), and all figures are sums over
    those counts, so a new policy or another set of rules needs no second pass over texts.
    """
    counts = judged.groupBy(F.col("quality.failures").alias("bits")).agg(F.count("*").alias("n"))
    lines = ", ".join(f"struct('{p}' AS policy, '{r}' AS rule, {mask_of(rules)} AS mask, {BITS[r]} AS bit)" for p, rules in policies.items() for r in rules)
    met = counts.select("bits", "n", F.expr(f"inline(array({lines}))"))
    total = lambda where: F.sum(F.when(F.expr(where), F.col("n")).otherwise(0))
    return met.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_rows"),
        total("(bits & bit) != 0").alias("n_failed"),
        total("(bits & mask) = bit").alias("n_only_this"),
        total("(bits & mask) = 0").alias("n_kept"),
        total("(bits & mask & ~bit) = 0").alias("n_kept_without"),
    )
