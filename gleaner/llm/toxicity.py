"""Toxicity of documents: disguised words are restored by a noisy-channel decoder, then scored."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

# Letters that digits and signs are commonly written for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
START, END = "^", "$"  # borders of a word; counted words hold letters only


@dataclass(frozen=True)
class ToxicityParams:
    """``sample`` bounds the labelled documents that words are chosen and weighted by (drawn by a hash of doc_id, not by place),
    and with them the classifier's words. The character model counts all rows and keeps the grams that make up a share of
    ``least_share`` of all or more: by that there are at most ``1 / least_share`` of each length, however large the corpus is."""

    order: int = 4
    least_share: float = 1e-7
    least_evidence: float = 8.0
    sample: int = 20_000
    held_entries: int = 400_000
    l2: float = 2e-5
    threshold: float = 0.7


EDGE = re.compile(r"^[^\w@$!|+]+|[^\w]+$")
RUN = re.compile(r"(.)\1\1")
# single signs with one or two separators between them; no sign is a separator, so that there is one way only to read a run
SPACED = re.compile(r"(?<!\S)(?:[^\s.,;:\-_*](?:[ \t]|[.\-_*]{1,2})){2,}[^\s.,;:\-_*](?!\w)")
LOWEST = -14.0  # log-probability of what the model has never seen


def plain(token: str) -> bool:
    """Whether a token is a word as it stands: letters only, none three times in a row."""
    return token.isalpha() and not RUN.search(token)


class CharModel:
    """Backed-off character n-grams; ``counts`` maps a gram to how often it occurs in words of the corpus."""

    def __init__(self, counts: Mapping[str, int], order: int):
        self.counts, self.order, self.known = counts, order, {}
        self.context: Counter[str] = Counter()
        for gram, n in counts.items():
            self.context[gram[:-1]] += n

    def log_p(self, before: str, after: str) -> float:
        key = (before, after)
        if key not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            value, discount = LOWEST, 0.0
            for at in range(len(before) + 1):
                context = before[at:]
                n = self.counts.get(context + after, 0)
                if n:
                    value = max(LOWEST, math.log(n / max(self.context[context], 1)) + discount)
                    break
                discount -= 0.9
            self.known[key] = value
        return self.known[key]


def add_grams(held: Counter[str], word: str, n: int, order: int) -> None:
    """Count every symbol of a word with the ``order - 1`` before it, ``n`` times."""
    padded = START * (order - 1) + word + END
    for end in range(order, len(padded) + 1):
        held[padded[end - order : end]] += n


def decode(noisy: str, model: CharModel) -> str:
    """The likeliest plain text behind ``noisy`` (Viterbi over its character lattice).

    A letter stands for itself or repeats the one before; a digit or sign stands for the letters it
    resembles, for itself, or for nothing; a separator stands for nothing or for the end of a word.

    A state is what the model still looks at. States so far behind the best that they cannot catch up go: two states that go on with the same
    letters are one after as many letters as the model looks back, and until then, and at the end, differ by no more than the lowest
    log-probability each time. A state points back to the ones before; texts are not carried along.
    """
    width = model.order - 1
    behind = (width + 1) * LOWEST
    # a state's score and its last piece of text, linked to the pieces before
    states: dict[str, tuple[float, tuple | None]] = {START: (0.0, None)}
    last = ""
    for c in noisy:
        following: dict[str, tuple[float, tuple | None]] = {}
        least = max(score for score, _ in states.values()) + behind
        letter = c.isalpha()
        for state, (score, link) in states.items():
            if score < least:
                continue
            if letter:
                moves = [((state + c)[-width:], score + model.log_p(state, c), c)]
                if c == last:
                    moves.append((state, score - 1.0, ""))
            else:
                moves = [((state + x)[-width:], score - 0.7 + model.log_p(state, x), x) for x in LEET.get(c, "")]
                if c.isdigit():
                    moves.append(((state + c)[-width:], score - 6.0, c))
                    if c == last:
                        moves.append((state, score - 1.0, ""))
                else:
                    moves.append((state, score - (0.2 if c in " \t.-_*" else 2.5), ""))
                    if state != START:
                        moves.append((START, score - 1.5 + model.log_p(state, END), " "))
            for target, total, piece in moves:
                if target not in following or following[target][0] < total:
                    following[target] = (total, (link, piece) if piece else link)
        states, last = following, c
    ends = {state: score + (model.log_p(state, END) if state != START else 0.0) for state, (score, _) in states.items()}
    link = states[max(ends, key=lambda state: (ends[state], state))][1]
    pieces = []
    while link is not None:
        link, piece = link
        pieces.append(piece)
    return "".join(reversed(pieces)).strip()


class Restorer:
    """Restores the words of a text; equal disguises are decoded once."""

    def __init__(self, model: CharModel, known: Mapping[str, object] | None = None):
        self.model, self.known = model, known
        self.seen: dict[str, str] = {}
        self.made: dict[str, tuple[str, ...]] = {}

    def __call__(self, noisy: str) -> str:
        if noisy not in self.seen:
            if len(self.seen) > 50_000:
                self.seen.clear()
            self.seen[noisy] = decode(noisy, self.model)
        return self.seen[noisy]

    def token(self, token: str) -> str:
        if token.isalpha():
            return self(token) if RUN.search(token) else token
        bare = EDGE.sub("", token)  # signs around a word are decoration
        return bare if not bare or plain(bare) else self(bare)

    def text(self, text: str) -> str:
        """The lower-cased text with every disguised word replaced, words separated by one space."""
        lowered = text.lower()
        whole = SPACED.sub(lambda m: self(m.group()) + " ", lowered)
        return " ".join(filter(None, map(self.token, whole.split())))

    def features(self, token: str) -> tuple[str, ...]:
        """The features of a token as it stands: its words, and their first four and five letters (``lik*``),
        which inflected forms share; only those in ``known``, if it is given."""
        if token not in self.made:
            if len(self.made) > 200_000:
                self.made.clear()
            found: list[str] = []
            for w in self.token(token).split():
                found.append(w)
                if len(w) > 4:
                    found.append(w[:4] + "*")
                if len(w) > 5:
                    found.append(w[:5] + "*")
            self.made[token] = tuple(found if self.known is None else filter(self.known.__contains__, found))
        return self.made[token]

    def all_features(self, text: str) -> set[str]:
        """The distinct features of the restored text; spaced-out words count joined and as they stand."""
        lowered = text.lower()
        found: set[str] = set()
        for token in set(lowered.split()):
            of_token = self.features(token)
            if of_token:
                found.update(of_token)
        for m in SPACED.finditer(lowered):
            for w in self(m.group()).split():
                found.update(self.features(w))
        return found


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[str]:
    return (v.as_py() or "" for v in batch.column(name))


def _counted(held: Mapping[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["gram", "n"])


def char_model(docs: DataFrame, params: ToxicityParams) -> dict[str, int]:
    """Counts of character n-grams in the plain words of all texts. Only grams of a share of ``least_share`` reach the driver,
    which bounds their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(words: Counter[str]) -> pa.RecordBatch:
            held: Counter[str] = Counter()
            for token, n in words.items():
                bare = token if token.isalpha() else EDGE.sub("", token)
                if plain(bare):
                    add_grams(held, bare, n, params.order)
            return _counted(held)

        words: Counter[str] = Counter()
        for batch in batches:
            for text in _texts(batch, "text"):
                words.update(text.lower().split())
                if len(words) > params.held_entries:  # bounded memory: partial counts go out
                    yield flushed(words)
                    words = Counter()
        yield flushed(words)

    longest = cut_lineage(docs.select("text").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    total = longest.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # the shorter grams end the longer ones
    ends = F.explode(F.transform(F.sequence(F.lit(1), F.lit(params.order)), lambda w: F.right("gram", w)))
    counts = longest.select(ends.alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = counts.filter(F.col("n") >= total * params.least_share).collect()
    return {r["gram"]: r["n"] for r in rows}


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class ToxicityModel:
    counts: dict[str, int]
    weights: dict[str, float]
    bias: float
    params: ToxicityParams


def _labelled(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> DataFrame:
    """``text, toxic`` of at most ``sample`` labelled documents outside the held-out rows, equal texts once.

    The sample is drawn from the labels, so only its ids travel and no text is shuffled to find them.
    """
    truth = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    truth = truth.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    truth = truth.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = truth.orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    found = rows.join(F.broadcast(drawn), "doc_id")  # at most ``sample`` ids
    return found.groupBy(F.md5("text").alias("digest")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).drop("digest")


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Learn the character model from all texts and the classifier from the labelled ones."""
    context = docs.sparkSession.sparkContext
    counts = char_model(docs, params)
    shared = context.broadcast(counts)  # bounded by least_share
    labelled = cut_lineage(_labelled(docs, labels, params))

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(CharModel(shared.value, params.order))

        def flushed(held: dict[str, list[int]]) -> pa.RecordBatch:
            columns = list(zip(*held.values(), strict=True)) if held else [(), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), *(pa.array(c, pa.int64()) for c in columns)], ["feature", "n", "n_toxic"]
            )

        held: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(_texts(batch, "text"), batch.column("toxic").to_pylist(), strict=True):
                for f in restore.all_features(text):
                    both = held.setdefault(f, [0, 0])
                    both[0] += 1
                    both[1] += toxic
                if len(held) > params.held_entries:
                    yield flushed(held)
                    held = {}
        yield flushed(held)

    table = (
        labelled.mapInArrow(evidence, "feature string, n long, n_toxic long")
        .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
        .filter("n_toxic > 1")
    )
    totals = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    total, toxic = totals["n"], totals["toxic"]
    prior = math.log((toxic + 0.5) / (total - toxic + 0.5))
    if not toxic or toxic == total:
        return ToxicityModel(counts, {}, prior, params)
    share = toxic / total
    # how much more often than by chance a feature's documents are toxic (signed log-likelihood ratio)
    p = F.col("n_toxic") / F.col("n")
    gain = 2 * (
        F.col("n_toxic") * F.log(p / share)
        + F.when(p < 1, (F.col("n") - F.col("n_toxic")) * F.log((1 - p) / (1 - share))).otherwise(0.0)
    )
    chosen = (
        table.withColumn("gain", gain).filter((p > share) & (F.col("gain") >= params.least_evidence))
        .orderBy(F.desc("gain"), "feature").select("feature").collect()  # of the bounded sample
    )
    names = {r["feature"]: i for i, r in enumerate(chosen)}

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(CharModel(shared.value, params.order), names)
        for batch in batches:
            found = [sorted(names[f] for f in restore.all_features(t)) for t in _texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column("toxic")], ["at", "toxic"])

    rows = labelled.mapInArrow(sparse, "at array<int>, toxic int").collect()
    weights, bias = _logistic([r["at"] for r in rows], np.array([r["toxic"] for r in rows], float), len(names), prior, params)
    return ToxicityModel(counts, {f: float(weights[i]) for f, i in names.items()}, bias, params)


def _logistic(at: list[list[int]], y: np.ndarray, width: int, prior: float, params: ToxicityParams) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on presence features, by damped gradient steps with momentum (Adam)."""
    row = np.repeat(np.arange(len(at)), [len(a) for a in at])
    col = np.array([c for a in at for c in a], int)
    w, b = np.zeros(width), prior
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for step in range(1, 401):
        z = b + np.bincount(row, w[col], len(at))
        off = balance * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        g = np.append(np.bincount(col, off[row], width) / len(at) + params.l2 * w, off.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def score(docs: DataFrame, model: ToxicityModel, out: str = "toxicity") -> DataFrame:
    """The rows of ``docs`` with the score of their whole text in column ``out`` (replaced if it exists)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by least_share and the sample
    rows = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        restore = Restorer(CharModel(model.counts, model.params.order), model.weights)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                z = [
                    model.bias + math.fsum(model.weights[f] for f in restore.all_features(t))
                    for t in _texts(part, "text")
                ]
                values = pa.array(1 / (1 + np.exp(-np.clip(np.array(z, float), -40, 40))), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, values], [*part.schema.names, out])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())]))


def restored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, restored``: the texts with disguised words decoded."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        restore = Restorer(CharModel(model.counts, model.params.order))
        for batch in batches:
            out = [None if t.as_py() is None else restore.text(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "restored"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("restored", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def judge(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """The rows of ``docs`` with ``toxicity`` (0 to 1) and ``rejected`` (from ``threshold`` on).

    Every text is judged whole. Null and empty texts get the score of a text without any known word. Rows with a
    null doc_id are scored like others but never learned from; labels that are null or not 0 or 1 are
    ignored, and without labels of both kinds every score is the smoothed share of toxic labels (a half
    without any). Repeated rows get equal scores; a repeated label counts as toxic if one of them is.
    Further columns pass through; existing columns of the two names are replaced.
    """
    scored = score(docs, fit(docs, labels, params))
    return scored.withColumn("rejected", F.col("toxicity") >= params.threshold)

