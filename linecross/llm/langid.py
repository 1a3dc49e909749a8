"""Operator 2: language identification in two steps.

A text's family (Germanic, Romance, ...) is predicted first, by linear support vector machines of one family against the rest. Then
only the languages of that family compete: one linear machine for every two of them, and the votes, with the margins as a
tie-break, name the language. Features are shares of hashed byte pairs and triples of the lower-cased letters, so a score is a mean
of table entries over the text; a batch is scored with a few gathers.

The machines learn from a bounded, documented sample: of each language the ``per_language`` labelled training texts with the
smallest text hashes, and of each family as many in equal parts. Everything else covers all rows.

Cases: null or empty texts and texts without a letter are ``und`` with score 0; rows without a label are never learned from; with
no labelled rows at all every text is ``und``; a single language or family has no rival and scores 1; repeated rows are scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from linecross.llm.common import byte_slices, crc_mod, give_back, map_batches

#: Family of each language code. Other codes form a family of their own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "celtic": ("br", "cy", "ga", "gd"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "uralic": ("et", "fi", "hu"),
    "semitic": ("am", "ar", "he", "mt"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

UNDETERMINED = "und"
#: Entries of the feature table; pairs and triples share it.
BUCKETS = 1 << 14
_STEP_BYTES = 1_000_000
#: Windows whose weights are gathered at once, so that a text of any length needs little memory.
_STEP_WINDOWS = 1 << 18
#: Columns of the feature table that training copies at once.
_COLUMNS = 1 << 11
_LETTER = regex.compile(r"\p{L}")
_DROPPED = bytes(b for b in range(128) if not (97 <= b <= 122 or b in b" \t\n\r"))
_ONE_SPACE = bytes(32 if b in b"\t\n\r" else b for b in range(256))


def _letters(text: str | None) -> bytes:
    """Lower-cased letters and spaces, with a space at both ends."""
    inner = (text or "").lower().encode("utf-8", "surrogatepass").translate(_ONE_SPACE, _DROPPED)
    return b" " + b" ".join(inner.split()) + b" "


def _features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the pair and of the triple that start at each byte but the last two."""
    b = data.astype(np.uint32)
    pair = b[:-2] * np.uint32(256) + b[1:-1]
    triple = pair * np.uint32(256) + b[2:]
    return ((pair * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int32), ((triple * np.uint32(2246822519)) >> np.uint32(18)).astype(np.int32)


def feature_counts(text: str | None) -> np.ndarray:
    data = np.frombuffer(_letters(text), np.uint8)
    if len(data) < 3:
        return np.zeros(BUCKETS, np.int64)
    pair, triple = _features(data)
    return np.bincount(pair, minlength=BUCKETS) + np.bincount(triple, minlength=BUCKETS)


def _machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear support vector machine by dual coordinate descent on the Gram matrix; rows of ``x`` carry a constant for the bias."""
    gram = x @ x.T + 1.0
    alpha, margin = np.zeros(len(y)), np.zeros(len(y))
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            new = min(max(alpha[i] + (1 - y[i] * margin[i]) / gram[i, i], 0.0), cost)
            step = new - alpha[i]
            if step:
                alpha[i] = new
                margin += step * y[i] * gram[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    weight = alpha * y
    # A part of the columns at a time, as each is copied in double precision.
    return np.concatenate([weight @ x[:, at:at + _COLUMNS] for at in range(0, x.shape[1], _COLUMNS)]), float(weight.sum())


class LanguageModel:
    """One table of weights: a column per family, then one per two languages of a family."""

    def __init__(self, counts: dict[str, np.ndarray], per_language: int):
        """``counts``: language -> feature counts, one row per sampled text. It is emptied, so that nothing is held twice."""
        self.languages = sorted(counts)
        family = {lang: FAMILY_OF.get(lang, "other") for lang in self.languages}
        self.families = sorted(set(family.values()))
        members = {f: [lang for lang in self.languages if family[lang] == f] for f in self.families}
        self.members = [[self.languages.index(lang) for lang in members[f]] for f in self.families]
        share, norms = {}, []
        for lang in list(counts):
            c = counts.pop(lang)
            share[lang] = (c / np.maximum(1, c.sum(axis=1, keepdims=True))).astype(np.float32, copy=False)
            norms.append(np.sqrt((share[lang] * share[lang]).sum(axis=1)))
            del c
        norms = np.concatenate(norms) if norms else np.ones(1)
        scale = np.float32(1 / max(1e-6, float(np.median(norms))))
        columns, biases = [], []

        def add(positive: np.ndarray, negative: np.ndarray) -> int:
            x = np.concatenate([positive, negative])
            x *= scale
            w, bias = _machine(x, np.repeat([1.0, -1.0], [len(positive), len(negative)]))
            columns.append((w * scale).astype(np.float32))
            biases.append(bias)
            return len(columns) - 1

        if len(self.families) > 1:
            part = {f: np.concatenate([share[lang][:max(1, per_language // len(members[f]))] for lang in members[f]])
                    for f in self.families}
            for f in self.families:
                add(part[f], np.concatenate([part[g][:max(1, per_language // (len(self.families) - 1))] for g in self.families if g != f]))
        self.pairs = [[(a, b, add(share[self.languages[a]], share[self.languages[b]])) for n, a in enumerate(own) for b in own[n + 1:]]
                      for own in self.members]
        self.weights = np.stack(columns, axis=1) if columns else np.zeros((BUCKETS, 0), np.float32)
        self.biases = np.array(biases)

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Margin of every machine for prepared texts."""
        sizes = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts) + b"  ", np.uint8)
        starts = np.cumsum(sizes) - sizes
        astray = np.sort(np.concatenate([starts + sizes - 1, starts + sizes - 2]))  # windows that reach into the next text
        sums = np.zeros((len(texts), self.weights.shape[1]))
        for at in range(0, len(data) - 2, _STEP_WINDOWS):
            pair, triple = _features(data[at:at + _STEP_WINDOWS + 2])
            each = self.weights[pair]
            each += self.weights[triple]
            each[astray[np.searchsorted(astray, at):np.searchsorted(astray, at + len(each))] - at] = 0
            first, end = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, at + len(each))
            sums[first:end] += np.add.reduceat(each, np.maximum(starts[first:end] - at, 0), axis=0, dtype=np.float64)
        return sums / np.maximum(1, 2 * (sizes - 2))[:, None] + self.biases

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of each text."""
        found, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        known = [n for n, text in enumerate(texts) if text and self.languages and _LETTER.search(text)]
        prepared, part, size = [], [], 0
        for n in known:
            prepared.append(_letters(texts[n]))
            part.append(n)
            size += len(prepared[-1])
            if size >= _STEP_BYTES or n == known[-1]:
                self._decide(part, prepared, found, scores)
                prepared, part, size = [], [], 0
        return found, scores

    def _decide(self, rows: list[int], prepared: list[bytes], found: list[str], scores: np.ndarray) -> None:
        margins = self.margins(prepared) if self.weights.shape[1] else np.zeros((len(rows), 0))
        sure = 1 / (1 + np.exp(-np.clip(2 * margins, -50, 50)))
        if len(self.families) > 1:
            own = margins[:, :len(self.families)].argmax(axis=1)
            odds = sure[:, :len(self.families)]
            base = odds[np.arange(len(rows)), own] / odds.sum(axis=1)
        else:
            own, base = np.zeros(len(rows), int), np.ones(len(rows))
        for f, members in enumerate(self.members):
            mine = np.flatnonzero(own == f)
            if not len(mine):
                continue
            votes = np.zeros((len(mine), len(self.languages)))
            worst = np.ones((len(mine), len(self.languages)))
            for a, b, column in self.pairs[f]:
                p = sure[mine, column]
                votes[:, a] += (p >= 0.5) + p * 1e-3
                votes[:, b] += (p < 0.5) + (1 - p) * 1e-3
                worst[:, a] = np.minimum(worst[:, a], p)
                worst[:, b] = np.minimum(worst[:, b], 1 - p)
            best = np.array(members)[votes[:, members].argmax(axis=1)]
            for n, k, score in zip(mine, best, base[mine] * worst[np.arange(len(mine)), best]):
                found[rows[n]], scores[rows[n]] = self.languages[k], score


def train_language_model(docs: DataFrame, per_language: int = 300, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from a sample of ``per_language`` different labelled texts of each language; it does not depend on partitioning.

    The driver gets one sparse row of at most ``BUCKETS`` counts per sampled text.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL").withColumn(
        "h", F.xxhash64("text"))
    # Hashes alone are ranked, each once, so copies take no places and texts stay where they are until they are chosen.
    ranked = rows.select("lang", "h").distinct().withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    chosen = ranked.where(F.col("n") <= per_language).select("lang", "h")
    # As many rows as the driver takes below, so every task can hold them, and no text is shuffled.
    sample = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = [feature_counts(t) for t in batch.column(1).to_pylist()]
        at = [np.flatnonzero(c) for c in counts]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype(np.int16) for x in at], pa.list_(pa.int16())),
                                           pa.array([c[x].astype(np.int32) for c, x in zip(counts, at)], pa.list_(pa.int32()))],
                                          ["lang", "at", "n"])

    found = map_batches(sample, run, "lang string, at array<smallint>, n array<int>").toArrow()
    counts: dict[str, list[np.ndarray]] = {}
    for name, at, n in zip(found["lang"].to_pylist(), found["at"], found["n"]):
        row = np.zeros(BUCKETS, np.float32)
        row[at.values.to_numpy()] = n.values.to_numpy()
        counts.setdefault(name, []).append(row)
    del found
    model = LanguageModel({name: np.stack(sorted(counts.pop(name), key=lambda r: r.tobytes())) for name in list(counts)}, per_language)
    give_back()
    return model


def predict_language(docs: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred",
                     score: str = "score") -> DataFrame:
    """All rows and columns, and the predicted language and its score; columns of the same names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * machines * 4 bytes
    names = [c for c in docs.columns if c not in (lang_pred, score)]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names), f"`{lang_pred}` string, `{score}` double"])

    def run(batch: pa.RecordBatch) -> pa.Table:
        told = []
        for part in byte_slices(batch, text):
            found, scores = shared.value.predict(part.column(text).to_pylist())
            told.append(pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(found, pa.string()), pa.array(scores)],
                                                   [*names, lang_pred, score]))
        return pa.Table.from_batches(told)

    return map_batches(docs, run, schema)


def held_out(modulus: int) -> str:
    return f"{crc_mod('doc_id', modulus)} = 1"
