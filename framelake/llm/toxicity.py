"""Toxicity by weak supervision.

Voters are words and word beginnings (lexicon), which labelled rows single out, a short list of insults, and patterns
over the whole text: a lexicon word with masked letters (id1ot, i.d.i.o.t), with stretched ones (idiooot), after an
address to the reader (you are such an idiot), or shouted.  Each votes toxic or abstains, and one votes clean where no
other speaks.  A generative label model takes the true label as hidden, estimates each voter's rate for either label by
expectation maximisation, and estimates the voters' correlations given the label: voters of a correlated cluster share
their evidence.  A linear classifier is trained on the posterior labels and scores every whole text; besides the voters
it sees the logarithm of how many words spoke.

Bounds of the fit, both parameters: ``sample`` labelled rows in expectation (twice that at most), drawn by the hash of
their id, and ``most`` learnt voters, the ones with the strongest evidence.

Labels are read only from rows for which ``usable`` holds.  Null and empty texts have no words and get the score of a
text without any hit.  Conflicting labels of one document count as toxic.  Without labels only the given list and the
patterns vote.  Rows are independent; repeated rows give equal result rows.  Very long texts are read whole, a text at
a time.  Other columns are kept as asked for; a kept column named score or predicted is replaced by the result's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.bpe import pieces
from framelake.llm.common import small_batches

LETTERS = re.compile(r"[^\W\d_]+")
#: Insults that vote from the start (fixed values).
INSULTS = ("idiot", "moron", "stupid", "dumb", "pathetic", "worthless", "trash", "scum", "loser", "clown", "disgusting", "garbage", "imbecile", "retard", "bastard", "vermin", "filth")
#: Lengths of word beginnings that can vote.
STEMS = (4, 5, 6, 7)
#: Words whose votes a worker remembers.
KNOWN = 100_000
#: Score from which a text counts as toxic.
THRESHOLD = 0.3


#: Look-alikes of letters (fixed values).
ALIKE = str.maketrans("013457@$!|", "oieastasil")
MASKS = "0123456789@$!|*._-"
MASK = re.compile(r"[0-9@$!|*._-]+(?=[^\W\d_])")
MASKED = re.compile(r"[^\W\d_]+(?:[0-9@$!|*._-]+[^\W\d_]+)+")
TRIPLE = re.compile(r"([^\W\d_])\1\1+")
#: Addresses to the reader, and what may stand between one and the word (fixed values).
ADDRESS = re.compile(r"\b(?:you|du|ihr|tu|vous|usted|ustedes|vosotros)\b(?:\W+(?:re|are|bist|seid|es|êtes|eres|son|a|an|such|so|ein|eine|un|une|una|tan)\b){0,3}\W+([^\W\d_]+)")
SHOUT = re.compile(r"[^\W\d_a-zß-ÿ]{4,}")
KINDS = ("masked", "stretched", "addressed", "shouted")


def words(text: str | None) -> set[str]:
    return set(LETTERS.findall(text.lower())) if text else set()


def masked(low: str) -> Iterator[str]:
    """Words with mask characters between their letters: found from such characters, as words without any are many."""
    end = 0
    for m in MASK.finditer(low):
        at = m.start()
        if at and at >= end and low[at - 1].isalpha():
            while at and (low[at - 1].isalpha() or low[at - 1] in MASKS):
                at -= 1
            if whole := MASKED.search(low, at):
                end = whole.end()
                yield whole[0]


def odd(text: str | None, ws: set[str]) -> set[tuple[str, str]]:
    """What the patterns find: kind and plain word, whether or not the lexicon has the word."""
    if not text:
        return set()
    low = text.lower()
    out = set()
    for m in masked(low):
        out |= {("masked", m.translate(ALIKE)), ("masked", "".join(LETTERS.findall(m)))}
    if TRIPLE.search(" ".join(ws)):
        for w in ws:
            if TRIPLE.search(w):
                out |= {("stretched", TRIPLE.sub(r"\1", w)), ("stretched", TRIPLE.sub(r"\1\1", w))}
    out.update(("addressed", w) for w in ADDRESS.findall(low))
    out.update(("shouted", w.lower()) for w in SHOUT.findall(text))
    return out


@dataclass
class Model:
    voters: list[str]
    weights: np.ndarray  # of the voters, then of the number of words that spoke
    bias: float
    rates: np.ndarray  # P(vote | clean), P(vote | toxic) of each voter
    cluster: np.ndarray  # size of each voter's correlated cluster
    prior: float

    def __post_init__(self) -> None:
        self.index = {v: i for i, v in enumerate(self.voters)}
        self.heads = sorted({len(v) - 1 for v in self.voters if v[-1] == "*"})

        self.known: dict[str, tuple[int, ...]] = {}

    def lexicon(self, w: str) -> tuple[int, ...]:
        own = self.known.get(w)
        if own is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            found = [self.index.get("=" + w), *(self.index.get(w[:n] + "*") for n in self.heads if len(w) >= n)]
            own = self.known[w] = tuple(i for i in found if i is not None)
        return own

    def features(self, ws: set[str], found: set[tuple[str, str]]) -> tuple[list[int], float]:
        hits, spoken = set(), 0
        for w in ws:
            if own := self.lexicon(w):
                hits.update(own)
                spoken += 1
        for kind, w in found:
            if own := self.lexicon(w):
                hits.add(self.index["~" + kind])
                hits.update(own)
                spoken += w not in ws
        return sorted(hits), float(np.log1p(spoken))

    def score(self, text: str | None) -> float:
        ws = words(text)
        hits, n = self.features(ws, odd(text, ws))
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[hits].sum() + self.weights[-1] * n, -500, 500))))


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Posterior of each row, rates and cluster sizes of the voters, prior.

    votes: rows x voters, 0 or 1.  given: the label of the labelled rows, which is one voter more (NaN: none).
    """
    n, m = votes.shape
    any_hit = votes.any(axis=1) if m else np.zeros(n, bool)
    post = np.where(np.isnan(given), np.where(any_hit, 0.9, 0.02), np.nan_to_num(given) * 0.9 + 0.05)
    size = np.ones(m)
    rates, prior = np.full((2, m), 0.5), 0.1
    for turn in range(rounds):
        prior = float(np.clip(post.mean(), 1e-3, 0.5))
        w = np.stack([1 - post, post])
        rates = (w @ votes + np.array([[0.02], [0.5]])) / (w.sum(axis=1, keepdims=True) + 1.0)
        rates[0] = np.minimum(rates[0], rates[1])  # a voter never speaks against its own vote
        if turn == 3 and m > 1:
            rest = votes - (post[:, None] * rates[1] + (1 - post[:, None]) * rates[0])
            s = rest.std(axis=0) + 1e-9
            size = ((rest.T @ rest) / n / np.outer(s, s) > 0.4).sum(axis=1).astype(float).clip(1)
        know = ~np.isnan(given)
        y = np.nan_to_num(given)
        own = [float(np.clip(((y == v) & know) @ (post if v else 1 - post) / max(know @ (post if v else 1 - post), 1e-9), 0.55, 0.97)) for v in (0, 1)]
        on = (np.log(rates[1]) - np.log(rates[0])) / size
        # silence of all voters is the one vote for clean, not as many as there are voters
        quiet = float(np.log(((~any_hit) @ post + 0.5) / (post.sum() + 1)) - np.log(((~any_hit) @ (1 - post) + 0.5) / ((1 - post).sum() + 1)))
        z = np.log(prior / (1 - prior)) + votes @ on + np.where(any_hit, 0.0, quiet)
        z += np.where(know, np.where(y == 1, np.log(own[1] / (1 - own[0])), np.log((1 - own[1]) / own[0])), 0.0)
        post = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return post, rates, size, prior


def linear(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by accelerated gradient."""
    n, m = x.shape
    w, b, vw, vb = np.zeros(m), -2.0, np.zeros(m), 0.0
    rate = 4.0 / (1 + (x**2).sum(axis=1).mean())
    for _ in range(steps):
        g = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y
        vw, vb = 0.9 * vw - rate * (x.T @ g / n + ridge * w), 0.9 * vb - rate * g.mean()
        w, b = w + vw, b + vb
    return w, b


def fit(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = 8000, most: int = 300, min_evidence: float = 12.0) -> Model:
    """Fits on about ``sample`` labelled rows at most, drawn by the hash of their id (the documented bound)."""
    small_batches(docs.sparkSession)
    usable_labels = labels.where(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    n = usable_labels.count()
    rate = min(1.0, sample / max(n, 1))
    drawn = usable_labels.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < rate * (1 << 30)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).limit(2 * sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # 2 * sample rows at most

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            ws = [words(t) for t in b.column(1).to_pylist()]
            found = [[f"{k}:{w}" for k, w in sorted(odd(t, own))] for t, own in zip(b.column(1).to_pylist(), ws, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(map(sorted, ws), pa.list_(pa.string())), pa.array(found, pa.list_(pa.string()))], ["doc_id", "toxic", "words", "odd"])

    seen = rows.mapInArrow(keyed, "doc_id long, toxic int, words array<string>, odd array<string>").persist()
    try:
        counted = seen.select(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
        pos, total = int(counted[0]), int(counted[1])
        prev = (pos + 1) / (total + 2)
        word = F.explode("words")
        ends = [F.concat(F.lit("="), F.col("w")), *[F.when(F.length("w") >= k, F.concat(F.substring("w", 1, k), F.lit("*"))) for k in STEMS]]
        each = seen.select("toxic", word.alias("w"), "doc_id").select("toxic", "doc_id", "w", F.explode(F.array(*ends)).alias("k")).where("k is not null")
        by_key = each.select("toxic", "doc_id", "k").distinct().groupBy("k").agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).where("p >= 3 and p >= 0.85 * n")
        # a beginning that many words share is more than one rare word that copies of a document repeat
        forms = each.join(by_key.select("k"), "k", "left_semi").select("k", "w").distinct().groupBy("k").agg(F.count("*").alias("forms"))
        by_key = by_key.join(forms, "k")
        evidence = F.col("p") * F.log((F.col("p") + 0.1) / (F.col("n") + 0.2) / F.lit(prev))
        found = by_key.withColumn("e", evidence).where((F.col("e") >= min_evidence) | ((F.col("e") >= min_evidence / 2) & (F.col("forms") >= 4))).orderBy(F.desc("e"), "k").limit(4 * most).collect()
        voters: list[str] = []
        heads: dict[str, int] = {}
        for r in found:
            stem = r["k"].strip("=*")
            # a longer key that a kept stem already covers adds nothing
            if len(voters) < most and not any(stem[:i] in heads and heads[stem[:i]] >= 0.8 * r["p"] for i in STEMS if i <= len(stem)):
                voters.append(r["k"])
                if r["k"][-1] == "*":
                    heads[stem] = r["p"]
        voters += ["=" + w for w in INSULTS if "=" + w not in voters]
        voters += ["~" + kind for kind in KINDS]
        model = Model(voters, np.zeros(len(voters) + 1), 0.0, np.zeros((2, len(voters))), np.ones(len(voters)), prev)
        sent = docs.sparkSession.sparkContext.broadcast(voters)

        def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = Model(sent.value, np.zeros(1), 0.0, np.zeros((2, 1)), np.ones(1), 0.1)
            for b in batches:
                got = [m.features(set(ws), {tuple(x.split(":", 1)) for x in found}) for ws, found in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(1), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.float64())], ["toxic", "hits", "n"])

        got = seen.mapInArrow(voted, "toxic int, hits array<int>, n double").collect()
    finally:
        seen.unpersist()
    votes = np.zeros((len(got) + 2, len(voters)))
    given = np.full(len(got) + 2, np.nan)
    spoken = np.zeros(len(got) + 2)
    for i, r in enumerate(got):
        votes[i, list(r["hits"])] = 1
        given[i], spoken[i] = r["toxic"], r["n"]
    votes[-1, [i for i, v in enumerate(voters) if v[1:] in INSULTS]] = 1  # so that the list speaks even without labels
    given[-2], given[-1], spoken[-1] = 0, 1, np.log1p(2)
    post, model.rates, model.cluster, model.prior = label_model(votes, given)
    w, model.bias = linear(np.c_[votes / np.sqrt(model.cluster), spoken], post)
    model.weights = np.r_[w[:-1] / np.sqrt(model.cluster), w[-1]]
    return model


def probability(model: Model, text: str | Column = "text") -> Column:
    """The score of a text.  Only the text goes to Python and only the score comes back."""
    small_batches(SparkSession.active())
    sent = SparkSession.active().sparkContext.broadcast(model)  # some hundred voters

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            for_each = (sent.value.score(t.as_py()) for t in b)  # one text at a time
            yield pa.array(for_each, pa.float64())

    return score(text)


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns of keep, score, predicted."""
    kept = [c for c in keep if c not in ("score", "predicted")]
    return docs.select(*kept, probability(model).alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
