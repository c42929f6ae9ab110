"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reported speech,
other) by a lexicon whose insults are learned from labelled documents; the
rest are short fixed lists. Transducers for target, negation and reported
speech are composed into one, which reads the symbols of a clause and marks
each insult or threat as plain, targeted, negated or reported. A document's
features are the weights of its marked matches, summed by mark; a logistic
regression on labelled documents says what each mark is worth.

Learning uses a sample of labelled rows of a fixed size (``SAMPLE``), taken by
hash of doc_id. Scoring reads whole texts, one pass, no shuffle.

Edge cases: a null or empty text has no match and gets the score of the
intercept; labels that are null or not 0 or 1, and labelled ids without a
document, teach nothing; a doc_id that several labels rows name is toxic if one
of them says so; with labels of one class only, or none, no insult is learned
and the score is about the share of toxic ones (0.12 without labels); an empty table gives an empty result. Other columns than
doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netloom.llm.units import steps
from netloom.llm.words import Words, scan
from netloom.session import materialize

#: Labelled documents that learning reads at most.
SAMPLE = 60_000
#: Bytes of text that one step takes at once.
STEP = 2 << 20
#: A word is significant if its log-likelihood ratio exceeds this times the log of
#: the number of words tested.
STRICT = 1.4
#: Log odds of a document being toxic before anything is learned.
CLEAN = -2.0
#: Lengths of word beginnings, in bytes, that may be insults as whole words may.
STEMS = (4, 5, 6)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: English, German, French and Spanish words, without accents' variants.
LISTS = {
    TARGET: "you your yours yourself u they them he she these those people du dich dir ihr euch sie "
    "tu te toi vous votre vos ils elles ti usted ustedes vosotros ellos ellas",
    NEGATION: "not no never none nobody neither nor without isn aren wasn don doesn didn "
    "nicht kein keine keinen nie niemals weder ohne ne pas jamais aucun aucune sans nunca nadie ningun sin",
    REPORT: "said says say quoted quote quotes wrote writes claims claimed reported reportedly according called "
    "sagte sagt schrieb angeblich zitiert laut dit disait selon cite ecrit dijo dice segun cita escribio",
    THREAT: "kill killed hurt destroy shoot burn stab beat murder die toten schlagen vernichten erschiessen "
    "tuer frapper bruler detruire matar golpear quemar destruir",
}
#: Bytes that end a clause.
CLAUSE_END = b".!?;:,\n\r()\"|"

MARKS = ("plain", "targeted", "negated", "reported", "threat", "threat_targeted")


@dataclass(frozen=True)
class Transducer:
    """Deterministic arcs (state, symbol) -> (state, output); a symbol without
    an arc of its own leaves the state through ``rest`` and passes unchanged."""

    arcs: dict[tuple[int, str], tuple[int, str]]
    rest: dict[int, int]

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol), (self.rest.get(state, state), symbol))


def compose(first: Transducer, second: Transducer, symbols: tuple[str, ...]) -> tuple[Transducer, tuple[str, ...]]:
    """What ``second`` does with the output of ``first``; states are numbered
    as they are reached from the start. Also the symbols that come out."""
    number = {(0, 0): 0}
    queue, arcs, out_symbols = [(0, 0)], {}, set()
    while queue:
        pair = queue.pop()
        for symbol in symbols:
            a, middle = first.step(pair[0], symbol)
            b, out = second.step(pair[1], middle)
            if (a, b) not in number:
                number[a, b] = len(number)
                queue.append((a, b))
            arcs[number[pair], symbol] = (number[a, b], out)
            out_symbols.add(out)
    return Transducer(arcs, {}), tuple(sorted(out_symbols))


def grammar(scope: int = 3) -> Transducer:
    """Over the symbols o i h t n r (other, insult, threat, target, negation,
    report): a negation holds for the next ``scope`` words, a target and a
    report for the rest of the clause. Outputs are the marks' first letters."""
    negation = Transducer(
        {(s, "n"): (scope, "o") for s in range(scope + 1)} | {(s, x): (0, "N") for s in range(1, scope + 1) for x in "ih"},
        {s: max(s - 1, 0) for s in range(scope + 1)},
    )
    report = Transducer({(0, "r"): (1, "o"), (1, "r"): (1, "o"), (1, "i"): (1, "R"), (1, "h"): (1, "R")}, {0: 0, 1: 1})
    target = Transducer({(0, "t"): (1, "o"), (1, "t"): (1, "o"), (1, "i"): (1, "T"), (1, "h"): (1, "H")}, {0: 0, 1: 1})
    both, symbols = compose(negation, report, ("o", "i", "h", "t", "n", "r"))
    whole, _ = compose(both, target, ("o", "i", "h", "t", "n", "r"))
    return whole


_SYMBOL = "oihtnr"
_MARK = {"i": 0, "T": 1, "N": 2, "R": 3, "h": 4, "H": 5}
GRAMMAR = grammar()


def _blank() -> np.ndarray:
    table = np.zeros(256, bool)
    table[:128] = True
    for a, b in (("0", "9"), ("A", "Z"), ("a", "z")):
        table[ord(a) : ord(b) + 1] = False
    return table


BLANK = _blank()
_ENDS_CLAUSE = np.zeros(256, bool)
_ENDS_CLAUSE[list(CLAUSE_END)] = True


def fixed_lexicon() -> tuple[np.ndarray, np.ndarray]:
    """(hashes, symbols) of the fixed lists, in order of hash."""
    words = [(w, symbol) for symbol, text in LISTS.items() for w in text.split()]
    hashes = scan(pa.array([w for w, _ in words]), BLANK).hashes
    order = np.argsort(hashes)
    return hashes[order], np.array([s for _, s in words], np.int8)[order]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _features_of(words: Words) -> list[np.ndarray]:
    return [words.hashes, *words.prefixes]


def match(texts: pa.Array, insults: tuple[np.ndarray, np.ndarray], fixed: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One row for each text: the weights of its matches, summed by mark."""
    words = scan(texts, BLANK, STEMS)
    sums = np.zeros((len(texts), len(MARKS)))
    weight = np.zeros(len(words.hashes))
    for hashes in _features_of(words):
        at, there = _find(insults[0], hashes)
        if there.any():
            weight = np.where(there, np.maximum(weight, insults[1][at]), weight)
    at, there = _find(fixed[0], words.hashes)
    symbol = np.where(there, fixed[1][at], OTHER) if len(fixed[0]) else np.zeros(len(weight), np.int8)
    symbol = np.where(weight > 0, INSULT, symbol)
    weight = np.where(symbol == THREAT, 1.0, weight)
    hits = np.flatnonzero((symbol == INSULT) | (symbol == THREAT))
    if not len(hits):
        return sums
    # a clause is the words between two bytes that end one, within a text
    breaks = np.flatnonzero(_ENDS_CLAUSE[words.raw])
    clause = np.searchsorted(breaks, words.first[hits])
    text = np.searchsorted(words.ends, hits, side="right") - 1
    edges = np.concatenate([[0], breaks, [len(words.raw)]])
    begin = np.maximum(edges[clause], words.text_ends[text])
    end = np.minimum(edges[clause + 1], words.text_ends[text + 1])
    spans = dict.fromkeys(zip(begin.tolist(), end.tolist(), text.tolist()))
    for a, b, i in spans:
        lo, hi = np.searchsorted(words.first, [a, b])
        state = 0
        for w, s in zip(weight[lo:hi].tolist(), symbol[lo:hi].tolist()):
            state, out = GRAMMAR.step(state, _SYMBOL[s])
            mark = _MARK.get(out)
            if mark is not None:
                sums[i, mark] += w
    return sums


def learning_rows(docs: DataFrame, labels: DataFrame, may_learn: Column, size: int = SAMPLE) -> DataFrame:
    """(doc_id, text, label) of at most ``size`` labelled documents for which
    ``may_learn`` (of doc_id) holds, those whose ids have the least hashes."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & may_learn)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    picked = materialize(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size), "toxicity_sample")
    # at most ``size`` rows of two numbers
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def learn_insults(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, weights): words and word beginnings that toxic documents have
    significantly more often than others, as log odds. Rows of one text count
    once, as toxic if one of them is, wherever they lie. The sample's size bounds
    what leaves the executors."""
    texts = rows.groupBy(F.sha2("text", 256).alias("_text")).agg(F.first("text").alias("text"), F.max("label").alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, size=STEP):
            frame = pa.Table.from_batches([batch]).to_pandas()
            words = scan(pa.array(frame["text"], pa.string()), BLANK, STEMS)
            owner = np.repeat(np.arange(len(frame)), np.diff(words.ends))
            toxic = frame["label"].to_numpy(np.int64)
            parts = [pd.DataFrame({"h": h[h != 0].view(np.int64), "d": owner[h != 0]}).drop_duplicates() for h in _features_of(words)]
            found = pd.concat([*parts, pd.DataFrame({"h": np.zeros(len(frame), np.int64), "d": np.arange(len(frame))})])
            counts = pd.DataFrame({"h": found["h"], "toxic": toxic[found["d"]], "n": 1}).groupby("h", as_index=False).sum()
            yield pa.RecordBatch.from_pandas(counts[["h", "toxic", "n"]], preserve_index=False)

    counts = texts.select("text", "label").mapInArrow(run, "h long, toxic long, n long").groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    counts = materialize(counts, "toxicity_counts")
    total = counts.where("h = 0").first()  # the row that counts the documents themselves
    if total is None or total["toxic"] in (0, total["n"]):
        return np.zeros(0, np.uint64), np.zeros(0)
    share, tests = total["toxic"] / total["n"], counts.count()
    rate = F.col("toxic") / F.col("n")
    clean = F.col("n") - F.col("toxic")
    g = 2 * (
        F.col("toxic") * F.log(rate / share) + F.when(clean > 0, clean * F.log((1 - rate) / (1 - share))).otherwise(F.lit(0.0))
    )
    odds = F.log((F.col("toxic") + 0.5) / (clean + 0.5)) - F.lit(float(np.log(share / (1 - share))))
    picked = (
        counts.where((F.col("h") != 0) & (F.col("toxic") > 0))
        .select("h", g.alias("g"), odds.alias("odds"), rate.alias("rate"))
        .where((F.col("g") > STRICT * float(np.log(tests + 1))) & (F.col("rate") > max(0.5, share)))
        .toArrow()
    )
    hashes = picked["h"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], picked["odds"].to_numpy().astype(float)[order]


def _squash(sums: np.ndarray) -> np.ndarray:
    return np.log1p(sums)


def fit(sums: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Logistic regression by Newton's method: the intercept, then a weight for
    each mark. Without rows to say otherwise a document is clean: the
    intercept is drawn to ``CLEAN`` and the weights to 0, as by one row."""
    x = np.concatenate([np.ones((len(sums), 1)), _squash(sums)], axis=1)
    prior = np.array([CLEAN, *[0.0] * len(MARKS)])
    w, penalty = prior.copy(), ridge * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        w = w + np.linalg.solve(hessian, x.T @ (labels - p) - penalty @ (w - prior))
    return w


@dataclass(frozen=True)
class Model:
    insults: tuple[np.ndarray, np.ndarray]
    fixed: tuple[np.ndarray, np.ndarray]
    weights: np.ndarray

    def score(self, sums: np.ndarray) -> np.ndarray:
        z = self.weights[0] + _squash(sums) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, may_learn: Column, size: int = SAMPLE) -> Model:
    """The lexicon and the weights; at most ``size`` rows of ``len(MARKS)``
    numbers and a label, and the lexicon, come to the driver."""
    rows = learning_rows(docs, labels, may_learn, size)
    insults, fixed = learn_insults(rows), fixed_lexicon()
    shared = docs.sparkSession.sparkContext.broadcast((insults, fixed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, size=STEP):
            sums = match(batch.column("text"), *shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").cast(pa.int32()), *[pa.array(sums[:, i]) for i in range(len(MARKS))]], names=["label", *MARKS]
            )

    schema = "label int, " + ", ".join(f"{m} double" for m in MARKS)
    taught = rows.select("text", "label").mapInArrow(run, schema).toArrow()
    # in an order of their own, so that sums do not depend on that of the rows
    taught = taught.sort_by([(c, "ascending") for c in taught.column_names])
    sums = np.stack([taught[m].to_numpy().astype(float) for m in MARKS], axis=1)
    return Model(insults, fixed, fit(sums, taught["label"].to_numpy().astype(float)))


def score(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """``docs`` with ``name`` (0 to 1) and, after it, the weights of its matches by
    mark; ``docs`` has no columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in steps(batches, size=STEP):
            sums = match(batch.column("text"), known.insults, known.fixed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(known.score(sums)), *[pa.array(sums[:, i]) for i in range(len(MARKS))]],
                names=[*names, name, *[f"{name}_{m}" for m in MARKS]],
            )

    fields = ", ".join([f"{name} double", *[f"{name}_{m} double" for m in MARKS]])
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *StructType.fromDDL(fields).fields]))


def may_learn(doc_id: Column) -> Column:
    """Rows that labels may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0
