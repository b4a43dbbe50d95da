"""Language identification with error-correcting output codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Byte n-grams of these lengths are hashed to so many features.
GRAMS = (1, 2, 3, 4)
FEATURES = 1 << 12
#: The classifiers are fitted on at most so many texts in all, spread evenly over the languages.
SAMPLE_TEXTS = 2000
#: Up to so many languages the code is exhaustive, all ways to part them; beyond it is drawn.
EXHAUSTIVE = 5
UNKNOWN = "und"
#: So many languages are learned at most, those of the most labelled texts.
LANGUAGES = 200
#: Size bands (UTF-8 bytes of the different words; they begin at these) in which it is calibrated how far a
#: text may lie from what was learned. Texts under the first size are too short to be told from
#: chance and always stay.
BANDS = (256, 1024, 4096)
#: One labelled text in so many is not learned from but calibrates, in languages that have at least so
#: many texts; a band with fewer of them than the last number has the bound of the shorter texts, if there is one.
ASIDE, ASIDE_FROM, BAND_TEXTS = 4, 40, 50
#: The share of set-aside texts that may lie beyond the bound, which is that quantile over all of them.
FALSE_DROPS = 0.0002
#: Where there are too few of them to tell that quantile, the bound is the strangest one's times this.
SLACK = 1.25
#: A text's strangeness is its best codeword's loss plus this times its distance (1 - cosine) from
#: the nearest language's mean features: letters that say little for or against any bit lie far.
DISTANCE_WEIGHT = 3.0
#: Texts nearer to a language than this share of the set-aside ones stay whatever their loss: they mix languages.
NEAR = 0.95
#: A text is ambiguous if the second codeword's probability is more than this share of the first's.
AMBIGUOUS = 0.8

_MULTIPLIERS = {n: np.uint32((0x9E3779B1 * (2 * n + 1)) & 0xFFFFFFFF) for n in GRAMS}
#: Digits, marks and blanks say nothing of a language: all become a blank.
_FOLD = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in range(256))


def features(texts: list[str]) -> np.ndarray:
    """Hashed byte n-gram frequencies of whole texts: square roots, each row of length 1."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    for i, text in enumerate(texts):
        # blanks in a row count once; the blanks at the ends mark first and last words
        folded = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_FOLD).split()) + b" "
        data = np.frombuffer(folded, np.uint8).astype(np.uint32)
        code, counts = data, np.zeros(FEATURES, np.int64)
        for n in range(1, max(GRAMS) + 1):
            if n > 1:
                if len(data) < n:
                    break
                code = (code[:-1] << np.uint32(8)) | data[n - 1 :]
            if n in GRAMS:
                counts += np.bincount((code * _MULTIPLIERS[n]) >> shift, minlength=FEATURES)
        total = counts.sum()
        if total:
            out[i] = np.sqrt(counts / total)
    return out


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """A codeword of -1 and 1 for each language: (languages, bits).

    Few languages get the exhaustive code, in which two words differ in over half of the bits. More
    get the best of several drawn codes of about 15 log2(languages) bits: the one whose nearest two
    words are farthest apart. Every bit parts the languages in two sets that aren't empty.
    """
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= EXHAUSTIVE:
        ways = np.arange(1, 2 ** (languages - 1))
        bits = (ways[None, :] >> np.arange(languages)[:, None]) & 1
        return (2 * bits - 1).astype(np.int8)
    draw, best, far = np.random.default_rng(seed), None, -1
    width = int(np.ceil(15 * np.log2(languages)))
    for _ in range(50):
        code = draw.choice(np.array([-1, 1], np.int8), (languages, width))
        code = code[:, np.abs(code.sum(axis=0, dtype=np.int64)) < languages]
        apart = (code.shape[1] - code.astype(np.int64) @ code.T.astype(np.int64)) // 2
        nearest = apart[~np.eye(languages, dtype=bool)].min()
        if nearest > far:
            best, far = code, nearest
    return best


@dataclass
class Model:
    """Languages, their codewords, a linear classifier for each bit, weights of the decoding, and the
    direction of each language's mean features."""

    languages: list[str]
    code: np.ndarray
    slopes: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray
    centres: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """A language's loss is the weighted sum over bits of the log loss of the classifier's margin
        against the codeword's bit."""
        margins = x @ self.slopes + self.offsets
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None])
        return (loss * self.weights[None]).sum(axis=2)

    def strangeness(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of each text's nearest codeword, its strangeness, and its distance alone."""
        total = self.losses(x)
        far = 1 - (x @ self.centres.T).max(axis=1)
        return total.argmin(axis=1), total.min(axis=1) + DISTANCE_WEIGHT * far, far

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Loss-weighted decoding: languages of nearer codewords, with less loss, are more probable."""
        total = self.losses(x)
        odds = np.exp(-(total - total.min(axis=1, keepdims=True)))
        return odds / odds.sum(axis=1, keepdims=True)


def fit(languages: list[str], label: np.ndarray, x: np.ndarray, steps: int = 200) -> Model:
    """Logistic regressions on the bits, and weights from how well each does on each language."""
    code = codewords(len(languages))
    target = (code[label] > 0).astype(np.float32)
    share = np.bincount(label, minlength=len(languages))
    each = (1.0 / share[label] / len(languages)).astype(np.float32)[:, None]
    slopes = np.zeros((x.shape[1], code.shape[1]), np.float32)
    offsets = np.zeros(code.shape[1], np.float32)
    m = [np.zeros_like(slopes), np.zeros_like(offsets)]
    v = [np.zeros_like(slopes), np.zeros_like(offsets)]
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(x @ slopes + offsets)))
        error = (p - target) * each
        for k, (value, grad) in enumerate(((slopes, x.T @ error + 1e-6 * slopes), (offsets, error.sum(axis=0)))):
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.999 * v[k] + 0.001 * grad * grad
            value -= 0.3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    hit = ((x @ slopes + offsets) * code[label] > 0).astype(np.float64)
    sure = np.stack([hit[label == k].mean(axis=0) for k in range(len(languages))])
    weights = np.maximum(sure, 1e-3)
    weights /= weights.sum(axis=1, keepdims=True)
    # summed over a codeword the weights count its bits in which it differs from the nearest other
    centres = np.stack([x[label == k].mean(axis=0) for k in range(len(languages))])
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return Model(languages, code, slopes, offsets, weights * max(2, code.shape[1] / 2), centres)


def _sample(usable: DataFrame, total: int) -> DataFrame | None:
    """Different texts of ``usable``, the same number of each language, ``total`` at most; None if there are none.

    Of rows that repeat id and text one counts. Those with the smallest hashes are taken, and an
    estimate of how many there are tells a bound for the hash, so that only a little more than
    the sample is shuffled, however large a language is.
    """
    place = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 63) - 1))
    rows = usable.select("lang", "text", place.alias("__place"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("__place", 0.02).alias("__n"))
    counts = counts.orderBy(F.desc("__n"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return None
    each = max(1, total // len(counts))
    enough = 1.25 * (each + 8 * each**0.5 + 16)  # a sample of that size holds ``each`` but for one time in 10**12
    bounds = [(r.lang, int(min(1.0, enough / r["__n"]) * ((1 << 63) - 1024))) for r in counts]
    bounds = usable.sparkSession.createDataFrame(bounds, "lang string, __bound long")
    # LANGUAGES rows at most
    few = rows.join(F.broadcast(bounds), "lang").where(F.col("__place") <= F.col("__bound"))
    few = few.dropDuplicates(["lang", "__place"])
    order = Window.partitionBy("lang").orderBy("__place")
    return few.withColumn("__k", F.row_number().over(order)).where(F.col("__k") <= each).select("lang", "text")


def learn(labelled: DataFrame) -> Model | None:
    """Fit on a bounded sample of ``labelled`` (doc_id, text, lang): ``SAMPLE_TEXTS`` at most.

    The sample is the same number of different texts of each language, of the ``LANGUAGES`` most frequent
    ones. Texts without a letter and null languages are left out. None if there is nothing to learn from.
    """
    usable = labelled.where(F.col("lang").isNotNull() & has_letter())

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # most features of a text are nought
        compressor = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            x = features(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([compressor.compress(r) for r in x])], ["lang", "x"])

    sample = _sample(usable, SAMPLE_TEXTS)
    if sample is None:
        return None
    rows = sample.mapInArrow(extract, "lang string, x binary").toArrow()
    if not rows.num_rows:
        return None
    names = rows.column(0).to_pylist()
    languages = sorted(set(names))
    # the driver holds the sample twice at most
    x, plain = np.empty((len(names), FEATURES), np.float32), zstandard.ZstdDecompressor()
    for k, row in enumerate(rows.column(1)):
        x[k] = np.frombuffer(plain.decompress(row.as_py()), np.float32)
    del rows
    place = {name: k for k, name in enumerate(languages)}
    label = np.array([place[name] for name in names])
    by_label = np.lexsort((x @ np.arange(FEATURES, dtype=np.float32), label))
    x = x[by_label]
    return fit(languages, label[by_label], x)


def has_letter(text: str = "text") -> F.Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred, score (probability, 0 to 1) and ambiguous.

    The prediction reads the whole text and nothing else. ``und`` with score 0 stands for a null or
    empty text, one without a letter, and for every text if there is no model. A tie goes to the
    first language by name. With one learned language every text with a letter is that one. Rows
    are neither moved nor gathered. Input columns named as the results are replaced.
    """
    own = ("lang_pred", "score", "ambiguous")
    columns = [c for c in docs.columns if c.lower() not in own]
    rows = docs.select(*columns, has_letter().alias("__letter"))
    schema = rows.select(*columns).schema
    for name, kind in zip(own, ("string", "double", "boolean")):
        schema = schema.add(name, kind)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                letter = np.array(batch.column(len(columns)).to_pylist(), bool)
                names = np.full(batch.num_rows, UNKNOWN, object)
                score, unsure = np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
                if model is not None and letter.any():
                    texts = batch.column(at).filter(pa.array(letter)).to_pylist()
                    p = model.probabilities(features(texts))
                    best = p.argmax(axis=1)
                    top = np.sort(p, axis=1)[:, ::-1]
                    names[letter] = np.array(model.languages, object)[best]
                    score[letter] = top[:, 0]
                    if p.shape[1] > 1:
                        unsure[letter] = top[:, 1] > AMBIGUOUS * top[:, 0]
                arrays = [batch.column(i) for i in range(len(columns))]
                arrays += [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return rows.mapInArrow(predict, schema)


def identified(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    return identify(docs, learn(labelled))


def _band(texts: list[str]) -> np.ndarray:
    """By the size of the different words: a word said again and again is as a short text."""
    sizes = [len(" ".join(set(t.split())).encode("utf-8", "replace")) for t in texts]
    return np.searchsorted(BANDS, sizes, "right")


def calibrated(labelled: DataFrame) -> tuple[Model | None, list[bool], np.ndarray]:
    """A model, which of its languages are calibrated, and the strangeness and distance each size band allows.

    In languages of ``ASIDE_FROM`` texts and more one text in ``ASIDE`` is not learned from; all of
    these give the bounds. Smaller languages are learned whole and not calibrated.
    """
    usable = labelled.where(F.col("lang").isNotNull() & has_letter())
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= ASIDE_FROM)
    large = [r.lang for r in counts.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()]
    aside = F.col("lang").isin(large) & (F.pmod(F.xxhash64(F.lit(1), "doc_id", "text"), F.lit(ASIDE)) == 0)
    model, bounds = learn(usable.where(~aside)), np.full((2, len(BANDS) + 1), np.inf)
    if model is None:
        return learn(usable), [], bounds

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                texts = whole.column(0).slice(start, 256).to_pylist()
                _, strange, far = model.strangeness(features(texts))
                arrays = [pa.array(_band(texts), pa.int32()), pa.array(strange, pa.float64()), pa.array(far, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, ["band", "strange", "far"])

    lies = usable.where(aside).select("text").mapInArrow(measure, "band int, strange double, far double")
    found = lies.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("strange").alias("most"),
        F.percentile_approx("strange", 1 - FALSE_DROPS, 100_000).alias("bound"),
        F.percentile_approx("far", NEAR, 100_000).alias("near"),
    )
    found = {r.band: r for r in found.collect()}  # a row a band
    for k in range(1, len(BANDS) + 1):
        own = found.get(k)
        if own is None:
            bounds[:, k] = bounds[:, k - 1]
            continue
        most = own.bound if own.n * FALSE_DROPS >= 1 else SLACK * own.most
        if own.n >= BAND_TEXTS:
            bounds[:, k] = most, own.near
        else:
            # longer texts are less strange
            bounds[:, k] = max(bounds[0, k - 1], most), bounds[1, k - 1]
    return model, [name in large for name in model.languages], bounds


def keep_identified(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``docs`` without those that have no language.

    These are null texts, texts without a letter, and those whose strangeness (the best codeword's
    weighted loss, and the distance from what was learned) is beyond that of all but ``FALSE_DROPS`` of the
    labelled texts of like size that were set aside, so clean texts are lost at that rate at most: encoded binary,
    key mashing, languages not learned. Where the best language or the size is not calibrated (see
    ``calibrated``), texts with a letter stay.

    Ambiguous texts stay: short and mixed ones are mostly clean. If there is nothing to learn from,
    nothing more can be told, and all texts with a letter stay. Rows aren't moved.
    """
    model, sure, bounds = calibrated(labelled)
    lettered = docs.where(has_letter())
    if model is None or not any(sure) or np.isinf(bounds).all():
        return lettered
    at, sure = docs.columns.index("text"), np.array(sure)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = batch.column(at).to_pylist()
                best, strange, far = model.strangeness(features(texts))
                most, near = bounds[:, _band(texts)]
                yield batch.filter(pa.array(~(sure[best] & (strange > most) & (far > near)), pa.bool_()))

    return lettered.mapInArrow(keep, docs.schema)
