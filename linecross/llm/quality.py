"""Operator 1: quality by weak supervision.

Rules look at a text's figures and vote good (1), bad (-1) or abstain (0). No rule decides alone: expectation-maximisation over the
votes of all documents estimates how often each rule votes and how often it is right for good and for bad documents, and the
posterior probability of "good" replaces a chain of filters that a document must all pass.

Spark computes the figures and votes once per text and counts equal vote patterns; a pattern is one of ``3 ** rules`` at most
(19,683), so the table of counts that the driver iterates over is bounded whatever the corpus. The learned weights come back as one
column expression.

Cases: a null or empty text has no words, fails the base rule and is not kept; repeated rows are scored each; an empty table gives
an empty result; with no votes at all the posterior is the prior.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from linecross.llm.common import map_batches, stage

#: Figures per text: those of the base rule first.
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_letters",
           "n_distinct_words")
#: Texts per vectorised step.
_STEP = 512
_SPACES, _SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
_ENDS = (b".", b"!", b"?", b"\xe2\x80\xa6", b'"', b":")


def figures(texts: list[str | None]) -> np.ndarray:
    """One row of ``FIGURES`` per text."""
    out = np.zeros((len(texts), len(FIGURES)), np.int64)
    hashes, sizes = [], []
    for n, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        words = data.split()
        sizes.append(len(words))
        hashes.append(np.fromiter(map(hash, words), np.int64, len(words)))
        if not words:
            continue
        lines = [line for line in data.split(b"\n") if line and not line.isspace()]
        out[n, :4] = (len(words), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, _SYMBOLS)),
                      len(lines) - len(set(lines)))
        out[n, 5:] = (len(lines), sum(line.rstrip().endswith(_ENDS) for line in lines),
                      len(text) if text.isalpha() else _letters(text, data), len(set(words)))
    out[:, 4] = _repeated(np.concatenate(hashes).view(np.uint64) if hashes else np.empty(0, np.uint64), np.array(sizes, np.int64))
    return out


#: Bytes that stand for a letter: ASCII letters, and the first byte of a longer character (an estimate, only used by a rule).
_LETTER = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC3))


def _letters(text: str, data: bytes) -> int:
    return len(data.translate(None, _LETTER))


def _repeated(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a 3-word window which the text has twice or more; words as 64-bit hashes."""
    text = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    if len(words) < 3:
        return np.zeros(len(sizes), np.int64)
    with np.errstate(over="ignore"):
        mixed = words ^ (words >> np.uint64(29))
        window = ((mixed[:-2] * np.uint64(0x9E3779B97F4A7C15) + mixed[1:-1]) * np.uint64(0xBF58476D1CE4E5B9) + mixed[2:])
        window = (window ^ (window >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + text[:-2] * np.uint64(0xD6E8FEB86659FD93)
    inside = np.flatnonzero(text[:-2] == text[2:])
    order = inside[np.argsort(window[inside], kind="stable")]
    equal = window[order][1:] == window[order][:-1]
    again = np.zeros(len(words), bool)
    twice = np.zeros(len(order), bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    start = order[twice]
    for k in range(3):
        again[start + k] = True
    return np.bincount(text[again].astype(np.int64), minlength=len(sizes))


def _three(good: str, bad: str) -> str:
    return f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"


#: Rule name -> SQL vote over the figures.
RULES = {
    "length": _three("n_words >= 100", "n_words < 20"),
    "word_length": _three("word_chars BETWEEN 3 * n_words AND 9 * n_words", "word_chars > 12 * n_words OR word_chars < 2 * n_words"),
    "symbols": _three("100 * n_symbols <= 2 * n_words", "100 * n_symbols > 30 * n_words"),
    "symbol_every_word": _three("100 * n_symbols <= 10 * n_words", "100 * n_symbols > 60 * n_words"),
    "dup_lines": _three("n_dup_lines = 0 AND n_lines > 2", "10 * n_dup_lines > 3 * n_lines AND n_lines > 4"),
    "repeats": _three("100 * n_repeat_words <= 10 * n_words", "100 * n_repeat_words > 40 * n_words"),
    "line_ends": _three("2 * n_ended_lines >= n_lines", "10 * n_ended_lines < n_lines AND n_lines > 2"),
    "letters": _three("100 * n_letters >= 75 * word_chars", "100 * n_letters < 60 * word_chars"),
    "variety": _three("100 * n_distinct_words >= 30 * n_words", "100 * n_distinct_words < 10 * n_words"),
}


class LabelModel:
    """Class-conditional vote rates of independent rules, fitted by expectation-maximisation over counted vote patterns.

    ``prior``: first guess of the share of good documents. First guesses of the rates say that a bad vote is rarely wrong and a good
    vote tells little, as text that is bad in one way is good in most others. They also break the symmetry, so "good" stays what
    the rules call good. Pseudo-counts of ``smooth`` times ten keep every rate inside (0, 1).

    Every round holds a rule's false alarms, bad votes among good documents, to ``false_alarms`` at most. Documents are bad in
    more than one way; without that bound two classes would fit the most frequent way alone and call the others good.
    """

    #: P(bad vote, no vote, good vote) in bad and in good documents before the first round.
    FIRST = ((0.30, 0.20, 0.50), (0.01, 0.39, 0.60))

    def __init__(self, rules: int, prior: float = 0.9, smooth: float = 0.2, false_alarms: float = 0.005):
        self.prior, self.smooth, self.false_alarms = prior, smooth, false_alarms
        self.rates = np.array([self.FIRST] * rules)

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        rule = np.arange(votes.shape[1])
        total = np.full(len(votes), math.log(self.prior / (1 - self.prior)))
        for r in rule:
            total += np.log(self.rates[r, 1, votes[:, r] + 1]) - np.log(self.rates[r, 0, votes[:, r] + 1])
        return total

    def fit(self, votes: np.ndarray, counts: np.ndarray, rounds: int = 100, tolerance: float = 1e-9) -> LabelModel:
        """``votes``: distinct patterns in a fixed order; ``counts``: documents that have them."""
        if not len(votes):
            return self
        first = self.rates.copy()
        total, before = counts.sum(), None
        for _ in range(rounds):
            good = 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -500, 500)))
            if before is not None and np.abs(good - before).max() < tolerance:
                break
            before = good
            self.prior = float(((good * counts).sum() + 9 * self.smooth) / (total + 10 * self.smooth))
            for c, weight in ((0, (1 - good) * counts), (1, good * counts)):
                for r in range(votes.shape[1]):
                    seen = np.bincount(votes[:, r] + 1, weights=weight, minlength=3) + 10 * self.smooth * first[r, c]
                    rate = seen / seen.sum()
                    if c and rate[0] > self.false_alarms:
                        rate = np.append(self.false_alarms, rate[1:] * (1 - self.false_alarms) / rate[1:].sum())
                    self.rates[r, c] = rate
        return self

    def posterior(self, names: list[str]) -> Column:
        """Probability of "good" from the vote columns."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for r, name in enumerate(names):
            weight = (np.log(self.rates[r, 1]) - np.log(self.rates[r, 0])).tolist()
            odds = odds + F.when(F.col(name) < 0, weight[0]).when(F.col(name) > 0, weight[2]).otherwise(weight[1])
        return 1 / (1 + F.exp(-odds))


def vote_table(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: dict[str, str] | None = None) -> DataFrame:
    """Key, figures, and one vote column ``vote_<rule>`` per rule."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1)
        found = np.concatenate([figures(texts.slice(n, _STEP).to_pylist()) for n in range(0, batch.num_rows, _STEP)])
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, k]) for k in range(len(FIGURES)))], ["key", *FIGURES])

    kind = docs.schema[key].dataType.simpleString()
    plain = map_batches(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run,
                        f"key {kind}, " + ", ".join(f"{c} bigint" for c in FIGURES))
    return plain.withColumns({f"vote_{name}": F.expr(sql).cast("tinyint") for name, sql in (rules or RULES).items()})


def fit_label_model(votes: DataFrame, names: list[str]) -> LabelModel:
    """Count vote patterns in Spark, fit on the counts."""
    counted = votes.groupBy(*names).agg(F.count(F.lit(1)).alias("docs")).collect()  # 3 ** rules rows at most
    rows = np.array(sorted([[*r][:len(names) + 1] for r in counted]), np.int64).reshape(-1, len(names) + 1)
    return LabelModel(len(names)).fit(rows[:, :-1], rows[:, -1].astype(float))


def quality_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: dict[str, str] | None = None,
                   threshold: float = 0.5) -> DataFrame:
    """Key, figures, votes, ``base_failed``, ``posterior`` and ``kept`` for every row.

    ``kept`` is false if the base rule fails (under 50 words, or more than half of the words in repeated 3-word windows), else
    whether the posterior reaches ``threshold``.
    """
    rules = rules or RULES
    names = [f"vote_{name}" for name in rules]
    staged = stage(vote_table(docs, key, text, rules), "votes")
    model = fit_label_model(staged, names)
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    scored = staged.withColumns({"base_failed": failed, "posterior": model.posterior(names)})
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)).withColumnRenamed("key", key)
