"""Language identification with string kernels.

A text is the set of its character 1- to 3-grams (blended spectrum, presence)
over a folded alphabet of 64 symbols.  The kernel of two texts is the number of
grams they share over the root of the product of their gram counts.  Landmark
texts give Nystroem features, and one-versus-rest kernel ridge regression gives
a linear function of them for each language.  The kernel to the landmarks, the
Nystroem map and the regression are all linear in a text's gram vector, so they
fold into one gram-by-language matrix, and a batch is scored by one product of
its sparse gram vectors with that matrix.

The model is fitted on a bounded sample: the `per_language` labelled texts of
each language with the least hash (deterministic, whole texts).  Gram sets are
made on the executors and only those of the sample reach the driver: at most
languages * per_language * 266,304 numbers, about 2,000 a text in practice.
Scoring reads every whole text once, without a shuffle.

Edge cases.  NULL texts and texts without a letter are `und`; so is every text if
nothing could be learned, as from an empty table.  Very long texts are read whole;
their gram sets are bounded.  Of languages with equal scores the first by name is
predicted.  Repeated rows get equal results; rows that tie in the sample's hash
are told apart by their content, and repeated ones may be in it more than once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import with_row_key

SYMBOLS = 64
CODES = SYMBOLS + SYMBOLS**2 + SYMBOLS**3
PER_LANGUAGE = 256
LANDMARKS = 64
RIDGE = 1e-3
SHARPNESS = 8.0
UNDETERMINED = "und"
KNOWN_PART = 0.5  # a recognised text has this part of the known grams usual for a learned language
PIECE = 1 << 20

_symbol = np.full(0x110000, 255, dtype=np.uint8)


def _fold(points: np.ndarray) -> np.ndarray:
    """0 for what is not a letter, 1-26 for a-z, 27-63 for other letters."""
    symbols = _symbol[points]
    new = np.unique(points[symbols == 255])
    if len(new):
        for p in new.tolist():
            c = chr(p).lower()[:1]
            _symbol[p] = (0 if not chr(p).isalpha() else ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) * 2654435761 % 2**32 % 37)
        symbols = _symbol[points]
    return symbols


def gram_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted gram codes of each text; empty for NULL and texts without a letter."""
    seen = np.zeros(CODES, dtype=bool)
    out = []
    for text in texts:
        points = np.frombuffer((text or "").encode("utf-32-le", "replace"), dtype=np.uint32)
        letters = False
        for low in range(0, len(points), PIECE):  # two symbols of overlap keep every gram
            s = _fold(points[low:low + PIECE + 2])
            letters = letters or bool(s.any())
            s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))].astype(np.int32) if len(s) else s
            seen[s] = True
            pairs = s[:-1] * SYMBOLS + s[1:]
            seen[SYMBOLS + pairs] = True
            seen[SYMBOLS + SYMBOLS**2 + pairs[:-1] * SYMBOLS + s[2:]] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        out.append(found.astype(np.int32) if letters else np.empty(0, np.int32))
    return out


def _shared(sets: list[np.ndarray], landmarks: list[np.ndarray]) -> np.ndarray:
    """The kernel of each set with each landmark, a batched matrix product."""
    codes = np.unique(np.concatenate(landmarks))
    basis = np.zeros((len(codes), len(landmarks)), dtype=np.float32)
    for k, grams in enumerate(landmarks):
        basis[np.searchsorted(codes, grams), k] = 1 / np.sqrt(len(grams))
    out = np.empty((len(sets), len(landmarks)))
    for low in range(0, len(sets), 64):
        block = np.zeros((min(64, len(sets) - low), len(codes)), dtype=np.float32)
        for k, grams in enumerate(sets[low:low + 64]):
            at = np.searchsorted(codes, grams)
            at = at[codes[np.minimum(at, len(codes) - 1)] == grams]
            block[k, at] = 1 / np.sqrt(len(grams))
        out[low:low + len(block)] = block @ basis
    return out


def known_shares(codes: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """The share of each set's grams that are among codes (sorted), of as many
    as there are codes at most: a very long text has more grams than that."""
    known = np.zeros(CODES, dtype=bool)
    known[codes] = True
    return np.array([known[s].sum() / max(1, min(len(s), len(codes))) for s in sets])


def fit(sets: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> dict:
    """One-versus-rest kernel ridge regression on Nystroem features.  The first
    `landmarks` texts of each language are the landmarks."""
    names = sorted(set(labels))
    if not names:
        return {"names": [], "codes": np.empty(0, np.int32), "weights": np.empty((0, 0), np.float32), "bias": np.empty(0), "least_known": KNOWN_PART}
    rank: dict[str, int] = {}
    chosen = []
    for k, name in enumerate(labels):
        rank[name] = rank.get(name, 0) + 1
        if rank[name] <= landmarks:
            chosen.append(k)
    marks = [sets[k] for k in chosen]
    values, vectors = np.linalg.eigh(_shared(marks, marks))
    keep = values > 1e-6 * values[-1]
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    features = _shared(sets, marks) @ whiten
    target = np.array([[1.0 if name == label else -1.0 for name in names] for label in labels])
    weight = np.array([1 / rank[label] for label in labels])  # languages count alike
    weight /= weight.sum()
    centre, bias = weight @ features, weight @ target
    moved = (features - centre) * weight[:, None]
    ridged = moved.T @ (features - centre) + ridge * np.eye(features.shape[1]) / features.shape[1]
    beta = np.linalg.solve(ridged, moved.T @ (target - bias))
    bias = bias - centre @ beta
    by_mark = whiten @ beta  # a landmark's share in each language's function
    codes = np.unique(np.concatenate(marks))
    # what the landmarks know of the sample's other texts tells what to ask of a text in a learned language
    others = known_shares(codes, [sets[k] for k in sorted(set(range(len(sets))) - set(chosen))])
    least = KNOWN_PART * (float(np.quantile(others, 0.01)) if len(others) else 1.0)
    weights = np.zeros((len(codes), len(names)))
    for grams, share in zip(marks, by_mark):
        weights[np.searchsorted(codes, grams)] += share / np.sqrt(len(grams))
    return {"names": names, "codes": codes.astype(np.int32), "weights": weights.astype(np.float32), "bias": bias, "least_known": least}


def predict(model: dict, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score (0 to 1, a softmax of the margins) of each text."""
    return _predict(model, gram_sets(texts))


def _predict(model: dict, sets: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
    known = [k for k, s in enumerate(sets) if len(s)] if model["names"] else []
    names, scores = [UNDETERMINED] * len(sets), np.zeros(len(sets))
    if not known:
        return names, scores
    if "table" not in model:
        model["table"] = np.zeros((CODES, len(model["names"])), dtype=np.float32)
        model["table"][model["codes"]] = model["weights"]
    size = np.array([len(sets[k]) for k in known])
    total = np.add.reduceat(model["table"][np.concatenate([sets[k] for k in known])].astype(np.float64),
                            np.concatenate(([0], np.cumsum(size)[:-1])), axis=0)
    margin = total / np.sqrt(size)[:, None] + model["bias"]
    best = margin.argmax(axis=1)
    part = np.exp(SHARPNESS * (margin - margin.max(axis=1, keepdims=True)) / 2)
    scores[known] = 1 / part.sum(axis=1)
    for k, b in zip(known, best):
        names[k] = model["names"][b]
    return names, scores


def recognised(model: dict, sets: list[np.ndarray]) -> np.ndarray:
    """Whether each text has a letter and reads like one of the learned
    languages; every text with a letter if no language was learned."""
    letters = np.array([len(s) > 0 for s in sets], dtype=bool)
    return letters & (known_shares(model["codes"], sets) >= model["least_known"]) if model["names"] else letters


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = gram_sets(batch.column("_t").to_pylist())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("lang", "rank", "_key1", "_key2")),
                                          pa.array(sets, pa.list_(pa.int32()))], ["lang", "rank", "_key1", "_key2", "grams"])


def _scored(shared, decide: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = dict(shared.value)
        for batch in batches:
            names, scores, reads = [], [], []
            for low in range(0, batch.num_rows, 256):
                sets = gram_sets(batch.slice(low, 256).column("_t").to_pylist())
                a, b = _predict(model, sets)
                names += a
                scores.append(b)
                if decide:
                    reads += recognised(model, sets).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(names, pa.string()),
                 pa.array(np.concatenate(scores) if scores else np.empty(0)), *([pa.array(reads, pa.bool_())] if decide else [])],
                ["_row", "lang_pred", "score", *(["recognised"] if decide else [])])
            pa.default_memory_pool().release_unused()
    return run


def held_out(id_col: str = "doc_id") -> F.Column:
    """crc32 of the id as text, mod 4, is 2; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> dict:
    """Fits on the rows that are not held out and have a language and a text."""
    rows = with_row_key(docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()), id_col, text_col)
    keys = ["_key1", "_key2"]
    first = Window.partitionBy("lang").orderBy(*keys)
    # the limit is applied in each task before the shuffle, then once more
    picked = (rows.select(F.col(lang_col).alias("lang"), *keys).withColumn("rank", F.row_number().over(first))
              .where(F.col("rank") <= per_language))
    texts = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("_t"), *keys)
    # at most per_language rows a language are broadcast
    found = texts.join(F.broadcast(picked), ["lang", *keys]).select("lang", "rank", *keys, "_t")
    made = found.mapInArrow(_grams, "lang string, rank int, _key1 long, _key2 long, grams array<int>").toPandas()
    made = made.drop_duplicates(["lang", *keys]).sort_values(["rank", "lang"])
    made = made[made["grams"].map(len) > 0]
    return fit([np.asarray(g, np.int32) for g in made["grams"]], made["lang"].tolist(), landmarks)


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
             carry: list[str] | None = None, decide: bool = False) -> DataFrame:
    """The columns `carry` of docs (all if not given; the id is one) with lang_pred, score and held_out; the prediction sees the text only.

    NULL texts and texts without a letter are `und` with score 0.  Extra
    columns pass through, those named like a result are replaced.  With `decide`
    there is a column recognised as well.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # grams of the landmarks x languages
    taken = ("lang_pred", "score", "held_out", *(["recognised"] if decide else []))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns if c not in taken]).alias("_row"),
                         F.col(text_col).cast("string").alias("_t"))
    schema = T.StructType([packed.schema["_row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           *([T.StructField("recognised", T.BooleanType())] if decide else [])])
    out = packed.mapInArrow(_scored(shared, decide), schema)
    return out.select("_row.*", *schema.names[1:]).withColumn("held_out", held_out(id_col))
