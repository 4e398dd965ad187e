"""Language of whole texts in two steps: family first, then one-versus-one within it.

All classifiers are linear support vector machines over the same hashed character n-grams (of
letters and word ends, lower case), scaled to parts of the text. So a text of any length is one
pass: every n-gram adds its weight to each classifier. Only the sample to train on is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.words import blocks, mix

UNKNOWN = "und"
BITS = 13
SCALE = 100.0
#: Rows of each language that the classifiers learn from at most, and languages up to which each may give so many.
SAMPLE, LANGUAGES = 300, 200
EPOCHS = 20
#: Families of language codes; any other code is in a family of the rest.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "it", "pt", "ca", "gl", "ro", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bg", "mk"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa"),
    "turkic": ("tr", "az", "kk", "uz"),
    "uralic": ("fi", "et", "hu"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

_letters: list = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000))
    return _letters[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of 1 to 3 characters of all texts end to end, and where each text's begin.

    Every character that is no letter counts as a word's end; n-grams of such alone are dropped."""
    joined = "\x00\x00" + "\x00\x00".join(texts) + "\x00\x00"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(letters()[points], points, 0).astype(np.uint64)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])])
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    shift = np.uint64(64 - BITS)
    keys = np.stack([mix(b + np.uint64(1 << 42)), mix((b << np.uint64(21)) + c + np.uint64(2 << 42)), mix((a << np.uint64(42)) + (b << np.uint64(21)) + c)])
    keep = b > 0
    slots = (keys >> shift).astype(np.uint16)[:, keep]
    first = np.concatenate([[0], np.cumsum(keep)])[np.minimum(bounds, len(keep))]
    return slots.T.ravel(), 3 * first


def parts(slots: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text the slots it has n-grams in, and the part of each among its n-grams."""
    out = []
    for a, b in zip(first[:-1], first[1:]):
        at, counts = np.unique(slots[a:b], return_counts=True)
        out.append((at.astype(np.int32), (SCALE * counts / max(1, b - a)).astype(np.float32)))
    return out


def svm(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 1.0, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by dual coordinate descent over sparse rows; y is -1 or 1."""
    w, alpha = np.zeros((1 << BITS) + 1), np.zeros(len(x))  # the last weight is the bias
    norm = np.array([float(v @ v) for _, v in x]) + 1 + 0.5 / cost
    random = np.random.default_rng(7)
    for _ in range(epochs):
        for i in random.permutation(len(x)):
            at, value = x[i]
            gradient = y[i] * (w[at] @ value + w[-1]) - 1 + alpha[i] * 0.5 / cost
            new = max(0.0, alpha[i] - gradient / norm[i])
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * y[i] * value
                w[-1] += (new - alpha[i]) * y[i]
                alpha[i] = new
    return w[:-1], float(w[-1])


class Model:
    """Machines for families (one against the rest) and for pairs of languages within a family."""

    def __init__(self, x: list[tuple[np.ndarray, np.ndarray]], langs: list[str]):
        self.families: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            self.families.setdefault(FAMILY_OF.get(lang, "rest"), []).append(lang)
        self.names = list(self.families)
        self.pairs = [(f, a, b) for f, members in self.families.items() for a, b in combinations(members, 2)]
        self.weights, self.bias = np.zeros((0, 1 << BITS), np.float32), np.zeros(0)
        if not x:
            return
        label = np.array(langs)
        family = np.array([FAMILY_OF.get(lang, "rest") for lang in langs])
        fitted = [svm(x, np.where(family == f, 1.0, -1.0)) for f in self.names] if len(self.names) > 1 else []
        for _, a, b in self.pairs:
            mine = (label == a) | (label == b)
            fitted.append(svm([x[i] for i in np.flatnonzero(mine)], np.where(label[mine] == a, 1.0, -1.0)))
        if fitted:
            self.weights = np.array([w for w, _ in fitted], np.float32)
            self.bias = np.array([b for _, b in fitted])

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; a text without a letter is UNKNOWN with score 0."""
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        slots, first = grams([t.lower() for t in texts])
        known = np.flatnonzero(np.diff(first))
        if not self.names or not len(known):
            return langs, scores
        sums = np.array([np.add.reduceat(w[slots], first[:-1][known], dtype=np.float64) for w in self.weights]).reshape(-1, len(known))
        margins = SCALE * sums / np.diff(first)[known] + self.bias[:, None]
        n = len(self.names) if len(self.names) > 1 else 0
        for k, at in enumerate(known):
            pick = int(margins[:n, k].argmax()) if n else 0
            family, least = self.names[pick], margins[pick, k] if n else np.inf
            members = self.families[family]
            votes = dict.fromkeys(members, 0.0)
            mine = [(a, b, m) for (f, a, b), m in zip(self.pairs, margins[n:, k]) if f == family]
            for a, b, m in mine:  # a vote each, margins within a vote break ties
                votes[a if m > 0 else b] += 1 + 0.5 * min(1.0, abs(m)) / len(mine)
            best = max(members, key=lambda x: (votes[x], x))
            least = min([least, *(m if a == best else -m for a, b, m in mine if best in (a, b))])
            langs[at], scores[at] = best, 1 / (1 + np.exp(-2 * least)) if least < np.inf else 1.0
        return langs, scores


def held_out(docs: DataFrame):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES) -> Model:
    """Learn from at most `sample` rows of each language, those with the smallest hash of doc_id,
    among rows that are not held out and have a text and a language.

    With more than `languages` languages each gives fewer rows, sample x languages in all, but one
    row at least: every language stays."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(docs))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = usable.select("doc_id", "lang").withColumn("_rank", rank).filter(F.col("_rank") <= sample)
    many = usable.select("lang").distinct().count()
    if many > languages:
        chosen = chosen.filter(F.col("_rank") <= max(1, sample * languages // many))
    ids = [tuple(r) for r in chosen.select("doc_id", "lang").distinct().collect()]
    few = docs.sparkSession.createDataFrame(ids, f"doc_id {dict(docs.dtypes)['doc_id']}, lang string")

    @F.pandas_udf("at array<int>, part array<float>")
    def counted(column: pd.Series) -> pd.DataFrame:
        rows = []
        for text in column:  # one at a time: a text may be long
            rows += parts(*grams([text.lower()]))
        return pd.DataFrame({"at": [a for a, _ in rows], "part": [p for _, p in rows]})

    texts = usable.join(F.broadcast(few), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    rows = texts.select("doc_id", "lang", counted("text").alias("x")).collect()  # 2^13 numbers a row at most
    rows.sort(key=lambda r: (r["doc_id"], r["lang"]))
    return Model([(np.array(r["x"]["at"], np.int32), np.array(r["x"]["part"], np.float32)) for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    A null or empty text, or one without a letter, is UNKNOWN with score 0; so is every text if
    there is nothing to learn from. A null doc_id counts as the empty text for held_out and is not
    learnt from. Equal texts get equal predictions; other columns are not read. Rows stay in their
    partitions; what goes to all tasks is the weights: 2^13 for each family and pair of languages in it.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, sample, languages))

    @F.pandas_udf("lang_pred string, score double")
    def run(column: pd.Series) -> pd.DataFrame:
        texts, langs, scores = [t if isinstance(t, str) else "" for t in column], [], []
        for a, b in blocks([len(t) for t in texts], 1 << 20):
            mine = model.value.predict(texts[a:b])
            langs += mine[0]
            scores += mine[1].tolist()
        return pd.DataFrame({"lang_pred": pd.Series(langs, dtype=object), "score": pd.Series(scores, dtype=float)})

    # ids stay in the JVM: beside a null, pandas would hold them as doubles
    return docs.select("doc_id", held_out(docs).alias("held_out"), run("text").alias("_p")).select("doc_id", "held_out", "_p.*")
