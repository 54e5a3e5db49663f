"""Quality classifier by co-training of two views: what a text says, and what is known about its page.

Each view has a logistic model over sparse yes/no features. In every round both
models score all documents, and each view hands the unlabelled documents at the top and at
the bottom of its own ranking to the other view as training rows. How sure it is there is measured:
the share of good rows that the labelled rows it was not trained on have in that part of
the ranking is the target of the pseudo-label, and a part that is no better
(or worse, at the bottom) than all rows together is not handed over; rows weigh as much as
their target differs from that of all. So a weak view teaches what it knows, and no more. Each view is calibrated on the same held-out rows, and a
logistic model over the two calibrated logits scores all documents.

Distribution. Models are fitted on the driver on at most ``LABELLED_ROWS`` labelled rows
plus ``ROUNDS`` * 2 * ``PSEUDO_ROWS`` pseudo-labelled ones; everything else runs over all
documents. Texts are read once, where they lie, and turned into feature numbers that are
written to the shared folder; every round reads those. A pass gives one number per
document, and only such narrow rows are shuffled to meet pages and labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstone.llm.words import mix, read_words
from loadstone.session import settle

LABELLED_ROWS = 10_000
PSEUDO_ROWS = 500
# Top and bottom share of the distinct unlabelled rows that a view hands over in a round, up to PSEUDO_ROWS each.
PSEUDO_SHARE = 0.05
# Held-out rows that measure a part of the ranking; where fewer lie in it, the nearest ones do.
MEASURED_ROWS = 20
ROUNDS = 3
KEEP = 0.5
# Texts that are turned into features at a time.
SLICE_DOCS = 256
_WORD_BITS = 18
_SHAPES = 1 << 12
# Everything in ASCII but letters and digits separates the words of the text view.
_SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))


def _bins(name: str, values: np.ndarray) -> np.ndarray:
    """Feature numbers of binned measures; they lie above those of words."""
    numbers = mix(values.astype(np.int64).view(np.uint64) + np.uint64(crc32(name.encode()) << 16))
    return (1 << _WORD_BITS) + (numbers % np.uint64(_SHAPES)).astype(np.int64)


def text_features(texts: pa.Array) -> list[np.ndarray]:
    """Features of each text: its words (hashed), and bins of how it is built."""
    out: list[np.ndarray] = []
    for at in range(0, len(texts), SLICE_DOCS):
        out += _slice_features(texts.slice(at, SLICE_DOCS))
    return out


def _slice_features(texts: pa.Array) -> list[np.ndarray]:
    words = read_words(texts, lower=True, blank=_SEPARATORS)
    docs, count = words.documents(), len(words.counts)
    buckets = (words.hashes >> np.uint64(64 - _WORD_BITS)).astype(np.int32)
    keys = np.unique((docs.astype(np.int32) << _WORD_BITS) | buckets)
    owner, feature = keys >> _WORD_BITS, keys & ((1 << _WORD_BITS) - 1)
    total = np.maximum(words.counts, 1)
    distinct = np.bincount(owner, minlength=count)
    letters = np.bincount(docs, weights=words.ends - words.starts, minlength=count)
    three = words.complete(3)
    marked = np.unique((docs[three].astype(np.uint64) << np.uint64(56)) | (words.windows(3)[three] >> np.uint64(8)))
    windows = np.bincount(docs[three], minlength=count)
    fresh = np.bincount((marked >> np.uint64(56)).astype(np.int64), minlength=count)
    raw = [(t.as_py() or "") for t in texts]
    symbols = np.array([int(_SYMBOLS[np.frombuffer(t.encode(), dtype=np.uint8)].sum()) for t in raw])
    lines = [[x for x in t.split("\n") if x.strip()] for t in raw]
    repeated = np.array([len(x) - len(set(x)) for x in lines])
    shapes = np.stack([
        _bins("words", np.log2(total)),
        _bins("distinct", 20 * distinct / total),
        _bins("letters", np.minimum(4 * letters / total, 60)),
        _bins("fresh", 10 * fresh / np.maximum(windows, 1)),
        _bins("symbols", np.minimum(10 * np.sqrt(symbols / total), 20)),
        _bins("lines", 10 * repeated / np.maximum([len(x) for x in lines], 1)),
    ], axis=1).astype(np.int32)
    cuts = np.searchsorted(owner, np.arange(1, count))
    return [np.concatenate([own, shape]) for own, shape in zip(np.split(feature, cuts), shapes)]


def page_features(source, lang, n_chars, url) -> list[int]:
    """Features of what is known about a document without its text; any of them may be null."""
    size = int(2 * np.log2(max(n_chars or 0, 0) + 1))
    names = [f"source={source}", f"lang={lang}", f"size={size}", f"page={url is not None}"]
    if url is not None:
        scheme, _, rest = url.partition("://")
        host, _, path = rest.partition("/")
        names.append(f"scheme={scheme}")
        names += [f"host={label}" for part in host.split(".") for label in {part, *part.split("-")}]
        names.append(f"host={host}")
        names += [f"has={mark}" for mark in ("?", "#", ".html", "utm_", "page=") if mark in path]
    return sorted({crc32(n.encode()) % (1 << _WORD_BITS) for n in names})


class Model:
    """Logistic model over sets of features: sorted ``features`` with ``weights``, a bias, and a calibration."""

    def __init__(self, features=None, weights=None, bias: float = 0.0):
        self.features = np.empty(0, dtype=np.int64) if features is None else features
        self.weights = np.empty(0) if weights is None else weights
        self.bias, self.scale, self.shift = bias, 1.0, 0.0

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        """Calibrated logits."""
        if not rows:
            return np.empty(0)
        sizes = np.array([len(r) for r in rows])
        flat = np.concatenate(rows).astype(np.int64)
        out = np.full(len(rows), self.bias)
        if len(self.features) and len(flat):
            at = np.searchsorted(self.features, flat)
            at[at == len(self.features)] = 0
            gain = np.where(self.features[at] == flat, self.weights[at], 0.0)
            out += np.bincount(np.repeat(np.arange(len(rows)), sizes), weights=gain, minlength=len(rows))
        return self.scale * out + self.shift

    def calibrate(self, rows: list[np.ndarray], good: np.ndarray) -> "Model":
        """Scale and shift the logits to fit rows the model was not trained on."""
        if len(set(good.tolist())) == 2:
            fitted = _descend(self.logits(rows)[:, None], good, 1e-3)
            # A view that does not help must not be turned around.
            self.scale, self.shift = max(fitted[0], 0.0), fitted[1]
        return self


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _descend(columns: np.ndarray, good: np.ndarray, ridge: float, steps: int = 50) -> np.ndarray:
    """Logistic regression of a few columns by Newton steps; the last coefficient is the bias."""
    design = np.hstack([columns, np.ones((len(columns), 1))])
    beta = np.zeros(design.shape[1])
    for _ in range(steps):
        p = _sigmoid(design @ beta)
        slope = design.T @ (p - good) + ridge * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + max(ridge, 1e-6) * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return beta


def fit(
    rows: list[np.ndarray], good: np.ndarray, weight: np.ndarray | None = None, least: int = 5, tilt: float = 2.5, ridge: float = 1.0, steps: int = 300
) -> Model:
    """Logistic model of the features that tell the classes apart; ``good`` is 0, 1 or a share between.

    A feature takes part if ``least`` rows have it and its share of good rows is ``tilt``
    standard errors from the overall share; bins of measures always do. With one class only
    the model is a constant.
    """
    weight = np.ones(len(good)) if weight is None else weight
    share = ((weight * good).sum() + 1) / (weight.sum() + 2)
    bias = float(np.log(share / (1 - share)))
    if len(set(good.tolist())) < 2:
        return Model(bias=bias)
    sizes = np.array([len(r) for r in rows])
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    names, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    mass = np.bincount(inverse, weights=weight[owner], minlength=len(names))
    hits = np.bincount(inverse, weights=(weight * good)[owner], minlength=len(names))
    error = np.sqrt(share * (1 - share) / mass)
    chosen = (counts >= least) & ((np.abs(hits / mass - share) >= tilt * error) | (names >= 1 << _WORD_BITS))
    place = (np.cumsum(chosen) - 1).astype(np.int32)
    keep = chosen[inverse]
    owner, column = owner[keep], place[inverse[keep]]
    del flat, inverse, keep
    width = int(chosen.sum())
    weights, moment, square = np.zeros(width), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        logits = bias + np.bincount(owner, weights=weights[column], minlength=len(rows))
        miss = weight * (_sigmoid(logits) - good)
        slope = np.append(np.bincount(column, weights=miss[owner], minlength=width) + ridge * weights, miss.sum())
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        change = 0.05 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        weights, bias = weights - change[:-1], bias - change[-1]
    return Model(names[chosen], weights, float(bias))


class _View:
    """One view's rows on the driver: features by document id, training rows, and the model."""

    def __init__(self, collect, score):
        self.collect, self.score = collect, score
        self.features: list[np.ndarray] = []
        self.good: list[float] = []
        self.weight: list[float] = []
        self.check: tuple[list[np.ndarray], np.ndarray] = ([], np.empty(0))
        self.model = Model()

    def train(self) -> None:
        good, weight = np.array(self.good, dtype=float), np.array(self.weight)
        self.model = fit(self.features, good, weight).calibrate(*self.check) if self.features else Model()

    def add(self, rows: DataFrame) -> int:
        """Rows (id, good) become training rows; how many there were.

        They weigh as much as their target tells: nothing at the share of good rows among all, 1 where all are sure.
        """
        found, base = self.collect(rows), float(np.mean(self.check[1]))
        for feature, good, _ in found:
            self.features.append(feature)
            self.good.append(good)
            self.weight.append(abs(good - base) / (1 - base if good > base else base))
        return len(found)

    def measured(self, cut: float, top: bool) -> float | None:
        """Share of good rows among the held-out ones beyond ``cut``, or None where it is not beyond that of all."""
        rows, good = self.check
        if not len(good):
            return None
        logits = self.model.logits(rows)
        order = np.argsort(-logits if top else logits, kind="stable")
        inside = int(np.count_nonzero(logits >= cut if top else logits <= cut))
        part = good[order[: max(inside, min(MEASURED_ROWS, len(good)))]]
        share, base = (part.sum() + 1) / (len(part) + 2), (good.sum() + 1) / (len(good) + 2)
        return float(share) if (share > base if top else share < base) else None


def quality_scores(
    docs: DataFrame, labels: DataFrame, pages: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label: Column | None = None, rounds: int = ROUNDS, labelled_rows: int = LABELLED_ROWS, pseudo_rows: int = PSEUDO_ROWS,
    trace: list[dict] | None = None,
) -> DataFrame:
    """Per document: ``id_col``, ``text_score``, ``page_score``, ``score`` (calibrated probabilities of good) and ``kept``.

    ``labels``: ``id_col`` and what ``label`` (by default quality is 1 and toxic is not 1) is true
    or false of; a null label does not count. ``pages``: ``id_col`` and ``url``; of several the smallest url counts.
    Two thirds of the labelled sample train the models, one third measures and calibrates them. Where
    all labels are of one class, or there are none, all scores are the class's smoothed share.
    ``trace`` takes a dict (round, view, top, rows, target, ids) for everything a view hands over.

    Null text counts as empty, null metadata as a value of its own. Null ids are scored
    without page or label; repeated rows are scored alike, and an id whose labels
    differ is not used. Other columns are not read. An empty table gives no rows.
    """
    if label is None:
        label = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) != 1)
    key = F.col(f"`{id_col}`").cast("long").alias("id")
    present = lambda name: F.col(name) if name in docs.columns else F.lit(None)
    texts = docs.select(key, F.col(f"`{text_col}`").cast("string").alias("text"))
    known = pages.select(key, F.col("url").cast("string").alias("url")).filter("id IS NOT NULL").groupBy("id").agg(F.min("url").alias("url"))
    facts = docs.select(
        key, present("source").cast("string").alias("source"), present("lang").cast("string").alias("lang"), present("n_chars").cast("long").alias("n_chars")
    )
    metadata = settle(facts.join(known, "id", "left"))
    judged = labels.select(key, label.cast("int").alias("good")).filter("id IS NOT NULL AND good IS NOT NULL")
    judged = settle(judged.groupBy("id").agg(F.min("good").alias("good"), F.max("good").alias("top")).filter("good = top").drop("top"))
    order = F.xxhash64("id")
    share = min(1.0, 1.2 * labelled_rows / max(judged.count(), 1))
    # Bounded by labelled_rows, so it may be broadcast.
    sample = settle(
        judged.filter(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(order, "id").limit(labelled_rows)
        .withColumn("fold", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)))
    )

    def describer(features):
        """Rows (id, features) of a batch, some at a time."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_DOCS):
                    part = batch.slice(at, SLICE_DOCS)
                    raw = [np.asarray(r, dtype="<i4").tobytes() for r in features(part)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id"), pa.array(raw, pa.binary()), pa.array([xxhash.xxh3_64_intdigest(r) >> 1 for r in raw], pa.int64())],
                        names=["id", "features", "same"],
                    )

        return run

    def of_page(batch: pa.RecordBatch) -> list[list[int]]:
        return [page_features(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("source", "lang", "n_chars", "url")))]

    def view(frame: DataFrame, features, name: str) -> _View:
        described = settle(frame.mapInArrow(describer(features), "id long, features binary, same long"))

        def collect(rows: DataFrame):
            """(features, good, fold) by id; an id that repeats counts once, so both views have the same rows."""
            found = described.drop("same").join(F.broadcast(rows), "id").toPandas().sort_values(["id", "features"]).drop_duplicates("id")
            return [(np.frombuffer(f, dtype="<i4"), float(g), int(k)) for f, g, k in zip(found["features"], found["good"], found["fold"])]

        def score(model: Model) -> DataFrame:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    logits = model.logits([np.frombuffer(f.as_py(), dtype="<i4") for f in batch.column("features")])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), batch.column("same"), pa.array(logits, pa.float64())], names=["id", "same", name]
                    )

            return described.mapInArrow(run, f"id long, same long, {name} double")

        return _View(collect, score)

    text = view(texts, lambda batch: text_features(batch.column("text")), "text_logit")
    page = view(metadata, of_page, "page_logit")
    for each in (text, page):
        rows = each.collect(sample)
        train = [r for r in rows if r[2] != 0] or rows
        check = [r for r in rows if r[2] == 0] or rows
        each.features, each.good, each.weight = [r[0] for r in train], [r[1] for r in train], [1.0] * len(train)
        each.check = ([r[0] for r in check], np.array([r[1] for r in check], dtype=float))
        each.train()

    used = sample.select("id")
    for number in range(rounds):
        handed = []
        for name, view, other in (("text_logit", text, page), ("page_logit", page, text)):
            # Rows of equal features are one: copies of a text must not use up a round.
            free = view.score(view.model).filter("id IS NOT NULL").join(judged, "id", "left_anti").join(used, "id", "left_anti")
            free = settle(free.groupBy("same").agg(F.min("id").alias("id"), F.max(name).alias(name)).drop("same"))
            most = min(pseudo_rows, ceil(PSEUDO_SHARE * free.count()))
            for top in (True, False):
                # Bounded by pseudo_rows.
                part = settle(free.orderBy(F.col(name).desc() if top else F.col(name), "id").limit(most))
                cut = part.agg(F.min(name) if top else F.max(name)).first()[0]
                target = None if cut is None else view.measured(cut, top)
                if target is not None:
                    handed.append((name, other, top, target, part.select("id", F.lit(target).alias("good"), F.lit(1).alias("fold"))))
        for name, other, top, target, part in handed:
            rows = other.add(part)
            used = used.unionByName(part.select("id"))
            if trace is not None:
                trace.append({"round": number, "view": name, "top": top, "rows": rows, "target": target, "ids": part})
        text.train()
        page.train()

    return _combined(text, page, id_col)


def _combined(text: _View, page: _View, id_col: str) -> DataFrame:
    """Scores of all documents by the logistic model over both calibrated logits."""
    good = text.check[1]
    weights = np.array([0.5, 0.5, 0.0])
    both = [view.model.logits(view.check[0]) for view in (text, page)]
    if len(set(good.tolist())) == 2 and len(both[0]) == len(both[1]):
        weights = _descend(np.stack(both, axis=1), good, 1e-3)
    texts, facts = text.score(text.model).drop("same"), page.score(page.model).drop("same")
    # One row per document row on the left; the page view is the same for all rows of an id.
    joined = texts.join(facts.filter("id IS NOT NULL").groupBy("id").agg(F.max("page_logit").alias("page_logit")), "id", "left")
    page_logit = F.coalesce("page_logit", F.lit(float(page.model.scale * page.model.bias + page.model.shift)))
    chance = lambda logit: 1 / (1 + F.exp(-logit))
    score = chance(float(weights[0]) * F.col("text_logit") + float(weights[1]) * page_logit + float(weights[2]))
    return joined.select(
        F.col("id").alias(id_col), chance(F.col("text_logit")).alias("text_score"), chance(page_logit).alias("page_score"), score.alias("score"),
    ).withColumn("kept", F.col("score") >= KEEP)
