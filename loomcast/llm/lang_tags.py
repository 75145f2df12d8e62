"""Language identification: a conditional random field labels the words of code-switched text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomcast.llm.common import whole
from loomcast.llm.crf import ChainField

UNKNOWN = "und"
WIDTH = 24
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Tagging:
    """Parameters. The field is fitted on at most ``sample_per_language`` labelled documents of
    each language (smallest hashes of their ids) and ``train_words`` words of them, dealt over
    their whole texts; prediction covers every word of every document."""

    sample_per_language: int = 150
    train_words: int = 60_000
    features: int = 1 << 16
    chain: int = 128
    lap: int = 8
    epochs: int = 40
    cached_words: int = 300_000
    batch_words: int = 200_000


def letters(text: str) -> list[str]:
    """Runs of letters in lower case. A run over 24 letters, as in scripts without spaces, is cut
    into pieces of that length, each a word of its own, so every letter is read."""
    runs = _WORD.findall(text.lower())
    if not any(len(w) > WIDTH for w in runs):
        return runs
    return [w[k : k + WIDTH] for w in runs for k in range(0, len(w), WIDTH)]


def word_features(words: list[str], lexicon: dict[str, int], size: int) -> np.ndarray:
    """Feature ids of words: affixes of 1-3 letters, all 2- and 3-grams with word ends, the
    class of the word in the lexicon, and its length. A word has 24 letters at most."""
    n = len(words)
    chars = np.array([f"^{w}$" for w in words], dtype=f"U{WIDTH + 2}").view(np.uint32).reshape(n, WIDTH + 2)
    chars = chars.astype(np.uint64)
    length = (chars != 0).sum(axis=1)
    mixed = lambda x, kind: ((x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind * 0x85EBCA6B)) >> np.uint64(23)) % np.uint64(size - 1) + np.uint64(1)
    two = chars[:, :-1] * np.uint64(1000003) + chars[:, 1:]
    three = two[:, :-1] * np.uint64(1000003) + chars[:, 2:]
    grams2 = np.where(chars[:, 1:] != 0, mixed(two, 1), 0)
    grams3 = np.where(chars[:, 2:] != 0, mixed(three, 2), 0)
    rows = np.arange(n)
    heads, tails = [], []
    head = np.zeros(n, np.uint64)
    tail = np.zeros(n, np.uint64)
    for k in range(1, 4):
        head = head * np.uint64(1000003) + chars[:, k]
        tail = tail * np.uint64(1000003) + chars[rows, np.maximum(length - 1 - k, 0)]
        heads.append(mixed(head, 10 + k))
        tails.append(mixed(tail, 20 + k))
    known = np.fromiter((lexicon.get(w, 0) for w in words), np.int64, n).astype(np.uint64)
    classes = [mixed(known, 30), mixed(np.minimum(length, 14).astype(np.uint64), 31)]
    return np.column_stack([grams2, grams3, *heads, *tails, *classes]).astype(np.int64)


def build_lexicon(texts: list[tuple[int, list[str]]], labels: int, most: int = 20_000) -> dict[str, int]:
    """Words seen in the labelled sample with a class: their likeliest language, how sure that is,
    and how frequent they are."""
    counts: dict[str, np.ndarray] = {}
    totals = np.ones(labels)
    for label, words in texts:
        for w, n in Counter(words).items():
            counts.setdefault(w, np.zeros(labels))[label] += n
        totals[label] += len(words)
    frequent = sorted(counts, key=lambda w: (-counts[w].sum(), w))[:most]
    out = {}
    for w in frequent:
        share = (counts[w] + 0.1) / totals
        share /= share.sum()
        best = int(share.argmax())
        out[w] = 1 + best + labels * (int(share[best] * 5) + 6 * min(3, int(np.log10(counts[w].sum()))))
    return out


@dataclass
class LanguageTagger:
    """The fitted field, its labels and lexicon."""

    labels: list[str]
    field: ChainField
    lexicon: dict[str, int]
    params: Tagging

    @classmethod
    def fitted(cls, samples: list[tuple[str, str]], params: Tagging = Tagging()) -> LanguageTagger:
        """Learn from (text, lang). Chains switch between documents every few words, so that
        transitions between languages are seen."""
        labels = sorted({lang for _, lang in samples})
        texts = [(labels.index(lang), letters(text)) for text, lang in samples]
        texts = [x for x in texts if x[1]]
        rng = np.random.default_rng(11)
        lexicon = build_lexicon(texts, max(1, len(labels)))
        field = ChainField.blank(params.features, max(1, len(labels)))
        by_label = [[words for label, words in texts if label == k] for k in range(len(labels))]
        ready = [k for k in range(len(labels)) if by_label[k]]
        words: list[str] = []
        y: list[int] = []
        label = 0
        while ready and len(words) < params.train_words:
            # half of the runs go on in the language before
            label = label if rng.random() < 0.5 and label in ready else int(rng.choice(ready))
            own = by_label[label][int(rng.integers(len(by_label[label])))]
            run = int(rng.integers(4, 60))
            at = int(rng.integers(max(1, len(own) - run)))
            words += own[at : at + run]
            y += [label] * len(own[at : at + run])
        if words:
            distinct = sorted(set(words))
            number = {w: i for i, w in enumerate(distinct)}
            tokens = np.fromiter((number[w] for w in words), np.int64, len(words))
            lengths = np.full(-(-len(words) // params.chain), params.chain)
            lengths[-1] = len(words) - params.chain * (len(lengths) - 1)
            field.fit(word_features(distinct, lexicon, params.features), tokens, np.array(y), lengths, params.epochs, 0.05)
        return cls(labels, field, lexicon, params)


class Predictor:
    """Applies a tagger to batches of texts, with a bounded cache of word scores."""

    def __init__(self, tagger: LanguageTagger):
        self.tagger = tagger
        self.field = tagger.field
        self.field.weights = self.field.weights.astype(np.float32)
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(tagger.labels)), np.float32)

    def _numbers(self, words: list[str]) -> np.ndarray:
        new = list({w for w in words if w not in self.known})
        if len(self.known) + len(new) > self.tagger.params.cached_words:
            self.known.clear()
            self.scores = self.scores[:0]
            new = list(set(words))
        if new:
            first = len(self.known)
            self.known.update(zip(new, range(first, first + len(new)), strict=True))
            parts = [
                self.field.emissions(word_features(new[k : k + 8192], self.tagger.lexicon, self.tagger.params.features))
                for k in range(0, len(new), 8192)
            ]
            self.scores = np.concatenate([self.scores, *parts])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def word_probabilities(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Per text, the probability of each language at each word. A text is cut into stretches of
        ``chain`` words; the chain of a stretch has ``lap`` more words on both sides, so that words
        at a cut know their neighbours too."""
        chain, lap = self.tagger.params.chain, self.tagger.params.lap
        numbers = np.concatenate([self._numbers_of(texts), np.zeros(0, np.int64)])
        sizes = np.array([len(words) for words in texts], np.int64)
        ends = np.cumsum(sizes)
        count = -(-sizes // chain)
        text = np.repeat(np.arange(len(sizes)), count)
        inside = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        first, last = (ends - sizes)[text], ends[text]
        start = first + inside * chain
        stop = np.minimum(start + chain, last)
        low, high = np.maximum(start - lap, first), np.minimum(stop + lap, last)
        lengths = high - low
        begins = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
        place = np.repeat(low, lengths) + within
        found = self.field.marginals(self.scores[numbers[place]].astype(np.float64), lengths)
        own = (place >= np.repeat(start, lengths)) & (place < np.repeat(stop, lengths))
        return np.split(found[own], ends[:-1]) if len(texts) else []

    def _numbers_of(self, texts: list[list[str]]) -> np.ndarray:
        return self._numbers([w for words in texts for w in words])

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language with the largest mean probability over all words of a text, and that mean."""
        words = [letters(t) for t in texts]
        words = [w if any(c.isalpha() for x in w for c in x) else [] for w in words]
        labels = self.tagger.labels
        if not labels:
            return [(UNKNOWN, 0.0)] * len(texts)
        out = []
        for own in self.word_probabilities(words):
            if not len(own):
                out.append((UNKNOWN, 0.0))
                continue
            mean = own.mean(axis=0)
            best = int(mean.argmax())
            out.append((labels[best], float(min(1.0, max(0.0, mean[best])))))
        return out


def labelled_sample(docs: DataFrame, params: Tagging, held_out: Column) -> list[tuple[str, str]]:
    """(text, lang) of the documents that the field may learn from: a bounded number."""
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    hashed = rows.select("doc_id", "lang", F.xxhash64("text").alias("hash"))
    chosen = hashed.withColumn("place", place).where((F.col("place") <= params.sample_per_language) & F.col("doc_id").isNotNull())
    wanted = chosen.select("doc_id", "lang", "hash").distinct()
    keys = docs.sparkSession.createDataFrame(wanted.collect(), wanted.schema)
    # The keys are as few as the sample. A repeated row brings its text once, and other texts of a
    # repeated id none.
    texts = rows.select("doc_id", "lang", F.xxhash64("text").alias("hash"), "text").join(F.broadcast(keys), ["doc_id", "lang", "hash"])
    found = texts.groupBy("doc_id", "lang", "hash").agg(F.first("text").alias("text")).collect()
    return [(r.text, r.lang) for r in sorted(found, key=lambda r: (r.doc_id, r.lang, r.text))]


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify_languages(docs: DataFrame, params: Tagging = Tagging(), tagger: LanguageTagger | None = None) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred and score, one row per input row.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text if there
    is nothing to learn from. lang, source and doc_id never take part in a prediction. Repeated
    rows and null ids (not held out) give rows of their own; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    fitted = tagger or LanguageTagger.fitted(labelled_sample(docs, params, held_out()), params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(fitted)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found, part, size = [], [], 0
            for text in texts:
                part.append(text)
                size += len(text)
                if size > params.batch_words * 6:
                    found += predictor.predict(part)
                    part, size = [], 0
            found += predictor.predict(part)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select("doc_id", held_out().alias("held_out"), whole().alias("text")).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
