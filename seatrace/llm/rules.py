"""Quality rules as a bitmask ledger: each rule is evaluated once, policies come later.

A ledger row holds the measurements of a document and one bit per failed rule. A policy is
a named set of rules, so applying another version, or asking what a rule alone decides,
never reads a text again. Native DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatrace.llm.common import words

BLANK_CHARACTERS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Bit number, name and SQL condition of failure over the measurements. Bits are never
#: given to another rule, so that old ledgers keep their meaning.
RULES = (
    (0, "few_words", "n_words < 50"),
    (1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    (2, "symbols", "10 * n_symbols > 4 * n_words"),
    (3, "duplicate_lines", "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines"),
    (4, "word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 20 * n_words)"),
    (5, "exclamations", "10 * n_exclamations > 3 * n_words"),
)

#: Versions of the policy: the rules by which a document goes.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    "v2": tuple(name for _, name, _ in RULES),
}
POLICY = "v2"

BITS = {name: bit for bit, name, _ in RULES}


def mask(names: tuple[str, ...]) -> int:
    return sum(1 << BITS[name] for name in names)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every row of ``docs``; a null text counts as empty.

    A word counts as repeated if a window of three words around it occurs twice or more.
    Windows are packed as hash and position into one long, sorted, and compared word by word
    with their neighbours; this stays within one row and near linear in its length.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", text.alias("_text"), words(F.col("text")).alias("_w"))
    n = F.size("_w")
    bits = F.length(F.bin(n))

    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = split.select(
        "doc_id",
        "_w",
        n.cast("long").alias("n_words"),
        bits.alias("_bits"),
        F.length(_without(F.col("_text"), BLANK_CHARACTERS)).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length("_text") - F.length(_without(F.col("_text"), "!"))).cast("long").alias("n_exclamations"),
        lines.alias("_lines"),
    )
    hashed = counted.withColumn(
        "_sorted",
        F.expr(
            """CASE WHEN n_words >= 3 THEN sort_array(transform(sequence(0, cast(n_words AS int) - 3),
                 i -> shiftleft(shiftrightunsigned(
                        xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2)), _bits), _bits) | i))
               ELSE array() END"""
        ),
    )
    same = """shiftrightunsigned(x ^ get(_sorted, {k}), _bits) = 0
        AND get(_w, cast(x & (shiftleft(1L, _bits) - 1) AS int)) =
            get(_w, cast(get(_sorted, {k}) & (shiftleft(1L, _bits) - 1) AS int))
        AND get(_w, cast(x & (shiftleft(1L, _bits) - 1) AS int) + 1) =
            get(_w, cast(get(_sorted, {k}) & (shiftleft(1L, _bits) - 1) AS int) + 1)
        AND get(_w, cast(x & (shiftleft(1L, _bits) - 1) AS int) + 2) =
            get(_w, cast(get(_sorted, {k}) & (shiftleft(1L, _bits) - 1) AS int) + 2)"""
    starts = hashed.withColumn(
        "_starts",
        F.expr(
            f"""sort_array(transform(filter(_sorted, (x, k) ->
                  (k > 0 AND {same.format(k="k - 1")}) OR
                  (k + 1 < size(_sorted) AND {same.format(k="k + 1")})),
                x -> cast(x & (shiftleft(1L, _bits) - 1) AS int)))"""
        ),
    )
    row = F.struct(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            """aggregate(transform(_starts, (p, k) ->
                 least(3, coalesce(get(_starts, k + 1) - p, 3))), 0L, (total, x) -> total + x)"""
        ).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        "n_exclamations",
    )
    # inline keeps a later filter from being pushed below, where it would measure again
    return starts.select(F.inline(F.array(row)))


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements of every row and ``failed``: bit b is set if rule b fails."""
    failed = F.lit(0).cast("long")
    for bit, _, condition in RULES:
        failed = failed.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return measured(docs).withColumn("failed", failed)


def with_policy(ledger_rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """``ledger_rows`` with ``kept``: no rule of the policy failed."""
    return ledger_rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def ablations(ledger_rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """For each rule of the policy: documents it fails, and those that it alone rejects.

    Documents are first counted by their bits, so that the rules are laid out over at most
    2 to the power of the rules rows.
    """
    chosen = mask(POLICIES[policy])
    counts = ledger_rows.groupBy(F.col("failed").bitwiseAND(F.lit(chosen)).alias("bits")).agg(
        F.count("*").alias("n")
    )
    rules = F.explode(
        F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << BITS[name]).cast("long").alias("bit")) for name in POLICIES[policy]])
    )
    return (
        counts.select("bits", "n", rules.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("n_kept"),
        )
    )
