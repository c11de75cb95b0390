"""Rule bitmask ledger: every quality rule is evaluated once, its failure kept as a bit beside the measurements.

Policies are versioned masks over the bits, so that a new policy, or leaving a rule out, is a bitwise test over
the ledger and never a second pass over the texts.

Defined cases: a null or empty text has no words (all measurements 0, so the word-count rule fails); texts of any length
are measured whole; a measurement equal to a rule's bound passes, and there are no other ties; repeated rows and repeated
doc_ids give a row each; a null doc_id stays null; other columns of the input are ignored; an empty
table gives an empty ledger.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append_batches, fresh, map_batches

MEASURES = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_pipes long, n_bangs long"

#: name -> failure test over the measurements. The place in this list is the bit, so only append.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_word_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols_per_word", "100 * n_symbols > 30 * n_words"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
    ("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    ("shouting", "100 * n_bangs > 30 * n_words"),
    ("table_rows", "100 * n_pipes > 20 * n_words"),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(1 << BIT[n] for n in names)


#: version -> mask of the rules that reject.
POLICIES = {"base": mask("few_words", "repeated_word_windows"), "v1": mask(*BIT)}


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measurements of one text. Bytes split on exactly the six ASCII separators of the word pattern."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * 8
    # continuation bytes start no code point
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "surrogatepass"))
    symbols = len(joined) - len(joined.translate(None, b"#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    repeated = 0
    if n >= 3:
        seen: dict = {}
        marks = bytearray(n)
        setdefault = seen.setdefault
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            for i, w in enumerate(windows):
                first = setdefault(w, i)
                if first != i:
                    marks[i] = marks[i + 1] = marks[i + 2] = 1
                    marks[first] = marks[first + 1] = marks[first + 2] = 1
            repeated = sum(marks)
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines), joined.count(b"|"), joined.count(b"!!")


def measure(docs: DataFrame) -> DataFrame:
    def make():
        def run(batch: dict) -> dict:
            columns = list(zip(*map(measure_text, batch["text"])))
            names = [x.split()[0] for x in MEASURES.split(", ")][1:]
            return {"doc_id": batch["doc_id"], **dict(zip(names, map(list, columns)))}

        return run

    return map_batches(docs.select("doc_id", "text"), make, MEASURES)


def ledger(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, measurements, failed (one bit per rule of RULES)."""
    bits = F.lit(0).cast("long")
    for i, (_, test) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(test), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measure(docs).withColumn("failed", bits)


def rejected(policy: str | int, failed: str = "failed") -> Column:
    bits = POLICIES[policy] if isinstance(policy, str) else policy
    return F.col(failed).bitwiseAND(F.lit(bits).cast("long")) != 0


def apply_policy(rows: DataFrame, policy: str | int = "v1") -> DataFrame:
    """A ledger with base_failed and the policy's verdict `kept` (the base rules always reject)."""
    return rows.withColumn("base_failed", rejected("base")).withColumn("kept", ~(rejected("base") | rejected(policy)))


def ablations(rows: DataFrame, policy: str | int = "v1") -> DataFrame:
    """One row per rule: rows failing it, rows only it rejects, rows kept if it were left out. One aggregation."""
    bits = POLICIES[policy] if isinstance(policy, str) else policy
    hit = F.col("failed").bitwiseAND(F.lit(bits).cast("long"))
    used = [(i, n) for i, (n, _) in enumerate(RULES) if bits >> i & 1]
    sums = rows.agg(
        F.count_if(hit == 0).alias("kept"),
        *[F.count_if(hit.bitwiseAND(F.lit(1 << i).cast("long")) != 0).alias(f"f{i}") for i, _ in used],
        *[F.count_if(hit == F.lit(1 << i).cast("long")).alias(f"o{i}") for i, _ in used],
    )
    each = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"f{i}").alias("failing"), F.col(f"o{i}").alias("only_this"), (F.col("kept") + F.col(f"o{i}")).alias("kept_without")) for i, n in used])
    return sums.select(F.inline(each))


def keep(docs: DataFrame, policy: str | int = "v1") -> DataFrame:
    """The documents that the policy keeps, with all their columns; each row is judged by its own text."""
    names = [x.split()[0] for x in MEASURES.split(", ")][1:]

    def make():
        def run(batch: dict) -> dict:
            columns = list(zip(*map(measure_text, batch["text"])))
            return {own[n]: list(c) for n, c in zip(names, columns)}

        return run

    own = {n: fresh(docs, f"__{n}") for n in names}
    rows = append_batches(docs, make, ", ".join(f"{own[n]} long" for n in names), ["text"])
    bits = POLICIES[policy] | POLICIES["base"] if isinstance(policy, str) else policy | POLICIES["base"]
    fails = F.lit(False)
    for i, (_, test) in enumerate(RULES):
        if bits >> i & 1:
            fails = fails | F.expr(re.sub(r"\b(n_\w+|word_chars)\b", lambda m: own[m.group()], test))
    return rows.filter(~fails).select(docs.columns)
