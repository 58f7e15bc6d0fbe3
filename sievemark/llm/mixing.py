"""Mixing to target weights with soft domain membership."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import per_text
from sievemark.session import materialize

BUCKETS = 1 << 16
_SYMBOLS = b"#*$%&|<>!"


def _share(part: int, whole: int) -> int:
    """Sixteen steps of a share, fine near zero."""
    return int(16 * (part / whole) ** 0.5) if whole else 0


def features_of(text: bytes | None) -> tuple[list[int], int]:
    """Buckets of the words and of a few shares of characters; number of words."""
    t = text or b""
    words = t.split()
    found = {zlib.crc32(w) % BUCKETS for w in set(t.lower().translate(None, b".,;:!?\"'()").split())}
    capitals = len(t) - len(t.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    for name, step in ((b"symbols", _share(len(t) - len(t.translate(None, _SYMBOLS)), len(t))), (b"capitals", _share(capitals, len(t))), (b"size", len(words).bit_length())):
        found.add(zlib.crc32(b"\x00%s%d" % (name, step)) % BUCKETS)
    return sorted(found), len(words)


@dataclass
class DomainModel:
    domains: list[str]
    weights: np.ndarray  # a row per bucket
    offset: np.ndarray
    #: Mean posterior of held-out rows of each domain, a row per domain; as if there were no doubt without it.
    confusion: np.ndarray | None = None

    def soft_shares(self, targets: Mapping[str, float]) -> list[float]:
        """What posteriors add up to where documents really have the wanted shares of domains."""
        wanted = np.array([targets.get(d, 0.0) for d in self.domains])
        return (wanted if self.confusion is None else wanted @ self.confusion).tolist()

    def posteriors(self, buckets: list[int]) -> list[float]:
        x = self.weights[buckets].sum(axis=0, dtype=np.float64) + self.offset
        e = np.exp(x - x.max()) if len(x) else x
        return (e / e.sum()).tolist() if len(x) else []


def _fit(rows: list[tuple[list[int], str]], domains: list[str], decay: float, rounds: int, rate: float, seen: int) -> DomainModel:
    weights, offset = np.zeros((BUCKETS, len(domains)), np.float32), np.zeros(len(domains))
    at = np.repeat(np.arange(len(rows)), [len(b) for b, _ in rows])
    bucket = np.concatenate([np.asarray(b, np.int64) for b, _ in rows])
    common = np.flatnonzero(np.bincount(bucket, minlength=BUCKETS) >= seen)
    place = np.full(BUCKETS, -1)
    place[common] = np.arange(len(common))
    at, col = at[place[bucket] >= 0], place[bucket][place[bucket] >= 0]
    want = np.zeros((len(rows), len(domains)))
    want[np.arange(len(rows)), [domains.index(d) for _, d in rows]] = 1
    w = np.zeros((len(common), len(domains)))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    offset = np.log((want.sum(axis=0) + 0.5) / (len(rows) + 0.5 * len(domains)))
    for step in range(1, rounds + 1):
        x = np.stack([np.bincount(at, w[col, c], len(rows)) for c in range(len(domains))], axis=1) + offset
        e = np.exp(x - x.max(axis=1, keepdims=True))
        error = (e / e.sum(axis=1, keepdims=True) - want) / len(rows)
        g = np.stack([np.bincount(col, error[at, c], len(common)) for c in range(len(domains))], axis=1) + decay / len(rows) * w
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights[common] = w
    return DomainModel(domains, weights, offset)


def log_loss(model: DomainModel, rows: list[tuple[list[int], str]]) -> float:
    """Mean negative log posterior of the rows' own domains."""
    own = [model.posteriors(b)[model.domains.index(d)] for b, d in rows]
    return float(-np.log(np.clip(own, 1e-12, 1)).mean())


#: Prior precisions of a weight that are tried.
DECAYS = (0.002, 0.1, 1.0, 4.0)


def train_domains(
    rows: list[tuple[list[int], str]], rounds: int = 150, rate: float = 0.05, decays: Sequence[float] = DECAYS, seen: int = 4
) -> DomainModel:
    """Multinomial logistic regression; buckets in fewer than ``seen`` rows get no weight.

    There are more buckets than rows, so a weak prior fits chance words where labels follow the text loosely, and a
    strong one blurs those that follow it well. Every fifth row is held out to find the precision with the
    lowest log loss, then all rows are fitted with it. The held-out rows also tell how much of each domain the posteriors see
    in documents of another.
    """
    domains = sorted({d for _, d in rows})
    if len(domains) < 2:
        return DomainModel(domains, np.zeros((BUCKETS, len(domains)), np.float32), np.zeros(len(domains)))
    held, rest = rows[::5], [r for i, r in enumerate(rows) if i % 5]
    tried = [_fit(rest, domains, d, rounds, rate, seen) for d in decays] if rest else []
    best = int(np.argmin([log_loss(m, held) for m in tried])) if tried else 0
    model = _fit(rows, domains, decays[best], rounds, rate, seen)
    model.confusion = np.eye(len(domains))
    for k, name in enumerate(domains):
        if tried and (own := [tried[best].posteriors(b) for b, d in held if d == name]):
            model.confusion[k] = np.mean(own, axis=0)
    return model


def domain_of(quality: Column, toxic: Column) -> Column:
    """Domain of a labelled row: toxic, else good or poor; null if the labels do not tell."""
    return F.when(toxic == 1, "toxic").when(quality == 1, "good").when(quality == 0, "poor")


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label_id: str, at_most: int) -> list[tuple[list[int], str]]:
    """Features and domain of at most ``at_most`` labelled documents, those with the smallest hashes of their ids."""
    known = labels.withColumn("domain", domain_of(F.col("quality"), F.col("toxic"))).filter("domain IS NOT NULL")
    known = known.groupBy(F.col(label_id).alias("__id")).agg(F.max("domain").alias("domain"))
    draw = F.xxhash64(F.lit("mixing"), "__id")
    chosen = known.orderBy(draw, "__id").limit(at_most)
    texts = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__t"))
    joined = texts.join(F.broadcast(chosen), "__id")  # at most ``at_most`` rows of two short fields

    def make() -> Callable[[bytes | None], tuple]:
        return features_of

    found = per_text(joined, "__t", make, "buckets array<int>, n long", keep=["__id", "domain"])
    rows = found.orderBy("__id", "buckets").limit(at_most).collect()
    return [(r["buckets"], r["domain"]) for r in rows]


def with_posteriors(docs: DataFrame, model: DomainModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``n_tokens`` (words) and ``posterior``, one share per domain of the model."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[bytes | None], tuple]:
        def judge(t: bytes | None) -> tuple:
            buckets, n = features_of(t)
            return n, sent.value.posteriors(buckets)

        return judge

    return per_text(docs, text, make, "n_tokens long, posterior array<double>", keep)


def rate_of(multipliers: list[float]) -> Column:
    """Nonnegative rate of a document under one multiplier per domain."""
    pull = sum((F.col("posterior")[j] * float(m) for j, m in enumerate(multipliers)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.lit(1.0) - pull)


def fit_rates(members: DataFrame, targets: list[float], ridge: float = 1e-3, rounds: int = 40, tolerance: float = 1e-9) -> list[float]:
    """Multipliers of the rates that bring the expected share of each domain to its target.

    Least squares over one rate per document: half the squared gaps between the domains' expected
    token totals and their targets (as shares of all tokens), plus ``ridge`` times the token-weighted
    squared distance of the rates from 1. A step goes down the gradient, scaled by the
    inverse Gram matrix of the domains over documents with positive rates, and is projected to
    nonnegative rates; steps that do not lower the objective are halved. The gradient of a rate
    is its document's posterior times one number per domain, so all rates of an iterate are given by
    these few numbers: a round is one aggregation, and nothing per document is kept.
    """
    k = len(targets)
    total = members.agg(F.sum("n_tokens").alias("n")).first()["n"] or 0
    if not total or not k:
        return [0.0] * k
    share = F.col("n_tokens") / F.lit(float(total))
    p = [F.col("posterior")[j] for j in range(k)]

    def measure(mu: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        rated = members.withColumn("__w", rate_of(mu.tolist()))
        w, on = F.col("__w"), (F.col("__w") > 0).cast("double")
        row = rated.agg(
            *[F.sum(share * p[j] * w).alias(f"s{j}") for j in range(k)],
            *[F.sum(share * p[i] * p[j] * on).alias(f"g{i}_{j}") for i in range(k) for j in range(i + 1)],
            F.sum(share * (w - 1) * (w - 1)).alias("off"),
        ).first()
        gaps = np.array([row[f"s{j}"] for j in range(k)]) - np.array(targets)
        gram = np.array([[row[f"g{max(i, j)}_{min(i, j)}"] for j in range(k)] for i in range(k)])
        return gaps, gram, 0.5 * float(gaps @ gaps) + 0.5 * ridge * row["off"]

    mu = np.zeros(k)
    gaps, gram, value = measure(mu)
    for _ in range(rounds):
        step = np.linalg.solve(gram + ridge * np.eye(k), gaps - ridge * mu)
        for _ in range(8):
            new = mu + step
            found = measure(new)
            if found[2] <= value:
                break
            step = step / 2
        else:
            break
        gain, mu, (gaps, gram, value) = value - found[2], new, found
        if gain <= tolerance:
            break
    return mu.tolist()


def mix(
    docs: DataFrame, model: DomainModel, targets: Mapping[str, float], budget: float = 1.0, text: str = "text",
    doc_id: str = "doc_id", ridge: float = 1e-3, allow_doubt: bool = False,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``posterior``, ``rate`` and ``copies``.

    ``targets`` gives the wanted share of each domain of the model (0 where it names none). With ``allow_doubt``, what
    posteriors see of a domain in documents of another is part of what their totals are fitted to, so that clean
    documents are not given up for it; a domain of target 0 then keeps more of its own documents too.
    ``budget`` is the wanted number of tokens as a multiple of what there is. ``copies`` is the rate
    rounded up or down by a draw from a hash of the id, so that it has the rate as its mean; it is the
    same for repeated rows. Null and empty texts have no tokens and do not count, but get the rate of
    their posterior. With an empty table or a model of no domain every rate is 1. Input columns
    named like a result are replaced.
    """
    added = ("n_tokens", "posterior", "rate", "copies")
    names = [c for c in docs.columns if c not in added]
    members = materialize(with_posteriors(docs.select(*names), model, text), "mixing-members")
    shares = model.soft_shares(targets) if allow_doubt else [targets.get(d, 0.0) for d in model.domains]
    mu = fit_rates(members.select("n_tokens", "posterior"), [budget * t for t in shares], ridge)
    draw = F.pmod(F.xxhash64(F.lit("copies"), doc_id), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rated = members.withColumn("rate", rate_of(mu))
    copies = F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")
    return rated.withColumn("copies", copies).select(*names, *added)
