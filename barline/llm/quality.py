"""Quality classifier by positive-unlabelled learning.

Only trusted positives and unlabelled web text are used; negatives are never read.  A
classifier is fitted by minimising the non-negative unbiased risk

    prior * R_pos(f) + max(0, R_unl(-f) - prior * R_pos(-f))

with the logistic loss (where the bracket turns negative, its gradient is ascended).  The
class prior is estimated first, as the least ratio of the unlabelled to the positive share
above a score of a plain positive-against-unlabelled model, on rows kept aside.

Inputs of a score are counts over the whole text only (shares of character classes,
repetition of words, word pairs, lines and three-word windows, lengths); id, language,
source and labels never are.  The fit reads at most ``MAX_POSITIVE`` positives and
``MAX_UNLABELLED`` unlabelled rows, those of the lowest id hash; every document is scored.

Defined cases: null and empty texts have all counts 0 and get the score of that point, as
has every text; repeated rows give repeated results, and of rows of one id that with the
least counts takes part in the fit; a null id stays null and takes no part in it; extra columns are ignored; without positives every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.common import remainder, text_rows
from barline.llm.compression import duplicate_lines, repeated_window_words

MAX_POSITIVE = 6_000
MAX_UNLABELLED = 12_000
THRESHOLD = 0.7

_MARKS = b"#*$%&|<>"
N_FEATURES = 18


def features(text: str | None):
    """Counts of a whole text as a vector."""
    import numpy as np
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = len(words), len(data)
    if not n:
        return np.zeros(N_FEATURES)
    h = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = max(1, int(h[65:91].sum() + h[97:123].sum()))
    marks = int(h[list(_MARKS)].sum())
    stops = int(h[[33, 44, 46, 63, 58, 59]].sum())
    other = int(h[33:48].sum() + h[58:65].sum() + h[91:97].sum() + h[123:127].sum()) - marks - stops
    distinct = len(set(words))
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = data.count(b"\n") + 1
    return np.array([
        np.log1p(n), h[65:91].sum() / letters, h[48:58].sum() / size, marks / size, stops / n, other / size,
        h[33] / n, h[124] / n, h[128:].sum() / size, size / n / 10,
        distinct / n, np.log((distinct + 1) / (n + 1)) / np.log(n + 2), same / n, repeated_window_words(words) / n,
        duplicate_lines(data) / lines, np.log1p(n / lines), max(map(len, words)) / (20 + max(map(len, words))), 1.0])


@dataclass(frozen=True)
class QualityModel:
    mean: list[float]
    scale: list[float]
    weights: list[float]
    prior: float

    def score(self, x):
        """Probability of the positive class for rows of features."""
        import numpy as np
        z = expand((x - np.array(self.mean)) / np.array(self.scale)) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def expand(z):
    """Standardised features (kept inside +-6), their squares and a constant."""
    import numpy as np
    z = np.clip(z, -6, 6)
    return np.hstack([z, z * z / 6, np.ones((len(z), 1))])


def fit_weights(p, u, prior: float, rounds: int = 1500, rate: float = 0.02, ridge: float = 1e-4):
    """Adam on the risk over the whole sample; a fixed number of rounds, no randomness."""
    import numpy as np
    w, m, v = np.zeros(p.shape[1]), 0.0, 0.0

    def sig(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    for t in range(1, rounds + 1):
        fp, fu = p @ w, u @ w
        pos = prior * (p.T @ (sig(fp) - 1)) / len(p)
        neg = u.T @ sig(fu) / len(u) - prior * (p.T @ sig(fp)) / len(p)
        risk = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        g = (-neg if risk < 0 else pos + neg) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(p, u) -> float:
    """Share of positives among the unlabelled: fit positive against unlabelled on one half,
    take on the other the least ratio of the shares above a score, with a margin for chance."""
    import numpy as np
    w = fit_plain(p[::2], u[::2])
    sp, su = np.sort(p[1::2] @ w), np.sort(u[1::2] @ w)
    cuts = np.quantile(sp, np.linspace(0.0, 0.9, 91))
    qp = 1 - np.searchsorted(sp, cuts) / len(sp)
    qu = 1 - np.searchsorted(su, cuts) / len(su)
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))
    best = np.argmin((qu + margin) / qp)
    return float(np.clip(qu[best] / qp[best], 0.05, 0.99))


def fit_plain(p, u, rounds: int = 400, rate: float = 0.05):
    """Logistic regression of positive against unlabelled, both sides of equal weight."""
    import numpy as np
    w, m, v = np.zeros(p.shape[1]), 0.0, 0.0
    for t in range(1, rounds + 1):
        a, b = 1 / (1 + np.exp(np.clip(p @ w, -30, 30))), 1 / (1 + np.exp(-np.clip(u @ w, -30, 30)))
        g = (u.T @ b) / len(u) - (p.T @ a) / len(p) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def fit_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                label_id: str = "doc_id", label_col: str = "quality", fold: int = 4, held_out: int = 2,
                max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> QualityModel:
    """Fits on rows outside the held-out fold."""
    import numpy as np
    rows = text_rows(docs, id_col, text_col).filter(F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), fold) != held_out))
    order = F.xxhash64("doc_id")
    trusted = (labels.filter(F.col(label_col) == 1).select(F.col(label_id).cast("bigint").alias("doc_id")).distinct()
               .join(rows.select("doc_id").distinct(), "doc_id", "left_semi"))
    chosen = (trusted.orderBy(order, "doc_id").limit(max_positive).select("doc_id", F.lit(True).alias("trusted"))
              .unionByName(rows.select("doc_id").distinct().orderBy(order, "doc_id").limit(max_unlabelled)
                           .select("doc_id", F.lit(False).alias("trusted"))))
    # the sample's ids are at most max_positive + max_unlabelled rows
    found = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "trusted")

    def run(batches):
        for b in batches:
            x = np.array([features(t) for t in b.column(1).to_pylist()]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(list(x), pa.list_(pa.float64()))],
                                             names=["doc_id", "trusted", "x"])

    # one row an id, so that rows that repeat one cannot add to the sample
    got = (found.mapInArrow(run, "doc_id long, trusted boolean, x array<double>")
           .groupBy("doc_id", "trusted").agg(F.min("x").alias("x")).toArrow())
    ids, trust = got.column("doc_id").to_numpy(), got.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, N_FEATURES)
    by_id = np.lexsort((x[:, 0], ids))
    trust, x = trust[by_id], x[by_id]
    if not trust.any() or trust.all():
        return QualityModel([0.0] * N_FEATURES, [1.0] * N_FEATURES, [0.0] * (2 * N_FEATURES + 1), 0.5)
    mean, scale = x[~trust].mean(axis=0), x[~trust].std(axis=0) + 1e-6
    z = expand((x - mean) / scale)
    p, u = z[trust], z[~trust]
    prior = estimate_prior(p, u)
    return QualityModel(mean.tolist(), scale.tolist(), fit_weights(p, u, prior).tolist(), prior)


def score_quality(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every document."""
    def run(batches):
        import numpy as np
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                x = np.array([features(t) for t in part.column(1).to_pylist()]).reshape(-1, N_FEATURES)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def keep_quality(docs: DataFrame, model: QualityModel, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores at least ``threshold``, with all their columns."""
    column = docs.columns.index(text_col)

    def run(batches):
        import numpy as np
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                x = np.array([features(t) for t in part.column(column).to_pylist()]).reshape(-1, N_FEATURES)
                yield part.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
