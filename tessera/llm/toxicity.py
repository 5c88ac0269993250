"""Toxicity scores: boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a lexicon, hits near the second person,
capitals, punctuation, and obfuscated words.  The lexicon is a short general
list together with words and word beginnings that are learned from the labelled
training rows: those whose documents are mostly toxic.

Training reads labels only where ``crc32(id as text) mod 5 <> 0``, and of those
at most ``SAMPLE`` documents of each class (the ones with the smallest hash of
their id), weighted back to the shares of the classes.  Calibration is fitted on
predictions for documents that the trees had not seen (three folds).  Scoring
reads every text whole, in one scan.

Defined cases: a null or empty text has all features 0 and gets the score that
the model gives those; labels that are null, or of unknown documents, are not
used; without labels of both classes the score is the share of toxic ones (0.5
without any); repeated rows get one score; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.gbt import Isotonic, Trees
from tessera.session import checkpoint_dir

#: Labelled documents of each class that training reads at most.
SAMPLE = 4000
#: Learned entries at most, the documents that one must be in, and the least share of toxic ones (classes evened out).
ENTRIES, IN_DOCS, PURITY = 3000, 5, 0.9
#: General words of abuse, one list for all languages.  Fixed values.
GENERAL = ("arschloch bastard bitch clown cretin disgusting dumb fool freak idiot imbecile imbécile jerk loser moron "
           "pathetic scum shit stupid stupide trash worthless idiota imbécil estúpido estúpida basura dumm abschaum "
           "müll crétin ordure connard").split()
#: Second person.  Fixed values.
SECOND = ("you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi vous votre vos tes ton usted "
          "ustedes tú ti vosotros").split()
_SECOND = re.compile(r"\b(?:" + "|".join(SECOND) + r")\b")
_MIXED = re.compile(r"\b[a-z]+[0-9@$!*]+[a-z]+\w*")
_SPACED = re.compile(r"\b\w(?:[.\-_*]\w){3,}\b")
_LEET = str.maketrans("013457@$!*", "oieastasi ")
_UPPER, _PUNCT = bytes(range(65, 91)), b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WINDOW = 300
#: Features of a text.
FIELDS = 14


class Features:
    """Feature rows of texts for one lexicon ``{entry: (weight, is a whole word)}``."""

    def __init__(self, lexicon: dict[str, tuple[float, bool]]):
        self.lexicon = lexicon
        self.find = ahocorasick.Automaton()
        for entry, (weight, whole) in lexicon.items():
            self.find.add_word(entry, (entry, weight, whole))
        if lexicon:
            self.find.make_automaton()

    def hits(self, low: str) -> list[tuple[int, str, float]]:
        """Position, entry and weight of words that are, or begin with, an entry; one hit a word."""
        out: dict[int, tuple[int, str, float]] = {}
        if not self.lexicon or not low:
            return []
        for end, (entry, weight, whole) in self.find.iter(low):
            lo = end + 1 - len(entry)
            if lo and low[lo - 1].isalnum() or whole and end + 1 < len(low) and low[end + 1].isalnum():
                continue
            if lo not in out or weight > out[lo][2]:
                out[lo] = (lo, entry, weight)
        return sorted(out.values())

    def row(self, text: str) -> list[float]:
        if not text:
            return [0.0] * FIELDS
        low = text.lower()
        raw = text.encode()
        n, words = len(raw), low.count(" ") + low.count("\n") + 1
        found = self.hits(low)
        at = [p for p, _, _ in found]
        most = near = j = 0
        for i, p in enumerate(at):
            while at[i] - at[j] > WINDOW:
                j += 1
            most = max(most, i - j + 1)
            near += bool(_SECOND.search(low, max(0, p - 40), p + 60))
        mixed = _MIXED.findall(low) if any(c in low for c in "013457@$!*") else []
        plain = [w.translate(_LEET).replace(" ", "") for w in mixed]
        plain += [re.sub(r"[.\-_*]", "", w) for w in _SPACED.findall(low)]
        hidden = sum(bool(self.hits(w)) for w in plain)
        caps = n - len(raw.translate(None, _UPPER))
        punct = n - len(raw.translate(None, _PUNCT))
        return [len(found), 100.0 * len(found) / words, len({e for _, e, _ in found}), most,
                sum(w for _, _, w in found), 100.0 * sum(w for _, _, w in found) / words,
                near, 100.0 * len(_SECOND.findall(low)) / words if len(found) else 0.0,
                caps / n, 100.0 * (raw.count(b"!") + raw.count(b"?")) / words, punct / n,
                100.0 * len(plain) / words, hidden, np.log1p(words)]


def _training_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, y`` of the training fold."""
    return (labels.where(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
            .groupBy("doc_id").agg(F.max("toxic").alias("y")))


def _training_rows(docs: DataFrame, usable: DataFrame, sample: int) -> DataFrame:
    """``doc_id, text, y`` of the sampled training documents; the sample (two numbers a row) is broadcast."""
    order = F.xxhash64("doc_id")
    picked = [usable.where(F.col("y") == c).orderBy(order, "doc_id").limit(sample) for c in (0, 1)]
    return docs.join(F.broadcast(picked[0].union(picked[1])), "doc_id").select("doc_id", "text", "y")


def learn_lexicon(rows: DataFrame, toxic: int, clean: int) -> dict[str, tuple[float, bool]]:
    """Entries whose documents are toxic in ``PURITY`` of cases, were both classes equally many."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]{3,}"), 0))
    starts = F.array_distinct(F.flatten(F.transform(words, lambda w: F.array(
        F.concat(w, F.lit("$")), *[F.when(F.length(w) > k, F.substring(w, 1, k)) for k in (4, 5, 6)]))))
    counts = (rows.select("y", F.explode(starts).alias("e")).where(F.col("e").isNotNull())
              .groupBy("e").agg(F.sum("y").alias("t"), F.count(F.lit(1)).alias("n")))
    rate = F.col("t") / max(toxic, 1)
    other = (F.col("n") - F.col("t") + 0.5) / max(clean, 1)
    best = (counts.where((F.col("t") >= IN_DOCS) & (rate / (rate + other) >= PURITY))
            .withColumn("lift", F.log(rate / other)).orderBy(F.desc(F.col("lift") * F.col("t")), "e").limit(ENTRIES).collect())
    return {r["e"].rstrip("$"): (float(r["lift"]), r["e"].endswith("$")) for r in sorted(best, key=lambda r: not r["e"].endswith("$"))}


class Model:
    def __init__(self, lexicon, trees: Trees, level: Isotonic):
        self.lexicon, self.trees, self.level = lexicon, trees, level

    def scores(self, texts: list[str | None]) -> np.ndarray:
        rows = Features(self.lexicon) if not hasattr(self, "_rows") else self._rows
        self._rows = rows
        return self.level(self.trees.margin(np.asarray([rows.row(t or "") for t in texts]).reshape(len(texts), FIELDS)))

    def __getstate__(self):
        return (self.lexicon, self.trees, self.level)

    def __setstate__(self, state):
        self.lexicon, self.trees, self.level = state


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the training fold of ``labels(doc_id, toxic)``."""
    checkpoint_dir(docs.sparkSession)
    usable = _training_labels(labels)
    rows = _training_rows(docs.select("doc_id", "text"), usable, sample).checkpoint()
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    lexicon = {w: (1.0, True) for w in GENERAL} | learn_lexicon(rows, toxic, clean)

    def features(batches):
        make = Features(lexicon)
        for b in batches:
            x = [make.row(t or "") for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), b.column("y"), pa.array(x, pa.list_(pa.float64()))],
                                  names=["doc_id", "y", "x"])

    got = sorted(rows.mapInArrow(features, "doc_id long, y int, x array<double>").collect())
    y = np.asarray([r["y"] for r in got], float)
    x = np.asarray([r["x"] for r in got], float).reshape(len(got), FIELDS)
    share = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}  # the sample's classes back to their shares
    w = np.where(y == 1, share.get(1, 0) / max(toxic, 1), share.get(0, 0) / max(clean, 1))
    fold = np.arange(len(y)) % 3
    unseen = np.zeros(len(y))
    for k in range(3):
        unseen[fold == k] = Trees().fit(x[fold != k], y[fold != k], w[fold != k] / max(w.mean(), 1e-9)).margin(x[fold == k])
    return Model(lexicon, Trees().fit(x, y, w / max(w.mean(), 1e-9) if len(y) else w), Isotonic().fit(unseen, y, w))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` ids with ``score double`` between 0 and 1; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                yield pa.record_batch([part.column(0), pa.array(shared.value.scores(part.column(1).to_pylist()))],
                                      names=["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")
