"""Toxicity: a subsequence string-kernel SVM with Nystroem landmarks.

The kernel compares two character strings by the subsequences of three
characters that they share, gaps allowed: every occurrence weighs
``DECAY ** span`` and spans reach ``SPAN`` characters, so an insult with
inserted or dropped characters keeps most of its subsequences. The unit of the
kernel is a token of a sentence (a run of single characters, as in a spaced-out
word, is one token).

Training takes labelled documents cut into sentences, which inherit the label.
In a toxic document only some sentences carry the label, so it is represented
by witnesses (multiple-instance learning): tokens that its sentences share with
many toxic and no clean ones, or else the token with the most look-alikes (by the
kernel) in other toxic documents and the fewest in clean ones, weighed by how clear
that is and chosen anew by the machine trained so far. Every toxic document
has a witness; of near copies with one label the first stands for all. Landmarks are a
spread-out sample of witnesses, and clean tokens; the Nystroem map ``K_mm^(-1/2) k_m`` turns
the kernel into features of a linear SVM. A document's score is a logistic curve
over its best two token decisions and the number of tokens that speak for
toxicity: one look-alike in a clean text counts less than several insults.

The subsequence kernel has an explicit (hashed) feature space, so the
decision function over landmarks folds into one weight vector: scoring a token
is one sparse product, cached per worker. Texts are scored where they lie.
"""

from __future__ import annotations

import itertools
import math
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import on_workers

#: Kernel: characters of a subsequence, longest span, weight per character of span, hashed features.
LENGTH, SPAN, DECAY, BITS = 3, 5, 0.7, 14
#: Training: labelled documents of each label (a bounded sample), landmarks, training tokens per class.
TRAIN_DOCS, LANDMARKS, TOKENS = 1_500, 256, 4_000
#: Clean tokens watched for false alarms, rounds of training, standard deviations that make a token
#: clear, decision of a text without tokens.
WATCHED, ROUNDS, CLEAR, LOWEST = 40_000, 3, 6.0, -3.0
#: Look-alikes: pairs of drawn kernel features that make two tokens meet; least weight of a witness.
BANDS, FAINT = 32, 0.2
#: Tokens kept in a worker's cache; longer tokens are scored in pieces of PIECE characters.
CACHE, PIECE = 400_000, 24
THRESHOLD = 0.3

_SENTENCE = re.compile(r"[.!?]+\s+|\n+")
_SPACED = re.compile(r"(?<!\S)\w(?:\s\w){2,}(?!\S)")
_OUTER = ".,;:!?\"'()[]{}*&%$#|-_"
#: Offsets of the characters of a subsequence after its first one, by span.
_GAPS = [c for c in itertools.combinations(range(1, SPAN), LENGTH - 1)]


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s and not s.isspace()]


def units(text: str) -> set[str]:
    """Distinct tokens of a text: lower case, outer punctuation stripped; three or more
    single characters in a row also form one token; long tokens are cut into pieces."""
    low = text.lower()
    bag = {w.strip(_OUTER) for w in set(low.split())}
    bag.update("".join(run.split()) for run in _SPACED.findall(low))
    bag.discard("")
    long = [w for w in bag if len(w) > PIECE]
    if long:
        bag.difference_update(long)
        for w in long:
            bag.update(w[i:i + PIECE] for i in range(0, len(w) - PIECE // 2, PIECE // 2))
    return bag


def _hash(a: np.ndarray) -> np.ndarray:
    a = a * np.uint64(0x9E3779B97F4A7C15)
    return (a ^ (a >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def kernel_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Explicit features of the subsequence kernel, normalised: (word, feature, value) triples.

    Words are framed by a start and an end mark.
    """
    rows, cols, vals = [], [], []
    size = max((len(w) for w in words), default=0) + 2 + SPAN
    codes = np.zeros((len(words), size), np.uint64)
    for i, w in enumerate(words):
        codes[i, 0] = 1
        codes[i, 1:len(w) + 1] = np.fromiter(map(ord, w), np.uint64, len(w)) + np.uint64(3)
        codes[i, len(w) + 1] = 2
    width = size - SPAN
    for gaps in _GAPS:
        h = _hash(codes[:, :width])
        ok = codes[:, :width] > 0
        for g in gaps:
            nxt = codes[:, g:g + width]
            h = _hash(h ^ (nxt + np.uint64(0x632BE59BD9B4E019)))
            ok &= nxt > 0
        r, c = np.nonzero(ok)
        rows.append(r)
        cols.append((h[r, c] >> np.uint64(64 - BITS)).astype(np.int64))
        vals.append(np.full(len(r), DECAY ** (gaps[-1] + 1)))
    row, col, val = np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)
    key, inverse = np.unique(row * (1 << BITS) + col, return_inverse=True)
    val = np.bincount(inverse, weights=val, minlength=len(key))
    row, col = key >> BITS, key & ((1 << BITS) - 1)
    norm = np.sqrt(np.bincount(row, weights=val * val, minlength=len(words)))
    return row, col, val / np.where(norm > 0, norm, 1)[row]


def landmark_kernel(words: list[str], phi: np.ndarray) -> np.ndarray:
    """Kernel values of tokens against landmarks (``phi``: features x landmarks)."""
    out = np.zeros((len(words), phi.shape[1]))
    for lo in range(0, len(words), 512):
        part = words[lo:lo + 512]
        row, col, val = kernel_features(part)
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        out[lo + row[first]] = np.add.reduceat(val[:, None] * phi[col], first, axis=0)
    return out


def spread(words: list[str], weights: np.ndarray, many: int) -> list[str]:
    """At most ``many`` words by weight and by what the ones before leave unexplained (pivoted Cholesky)."""
    row, col, val = kernel_features(words)
    left, parts, out = np.ones(len(words)), np.zeros((len(words), min(many, len(words)))), []
    for j in range(parts.shape[1]):
        p = int(np.argmax(left * weights))
        if left[p] < 1e-3:
            break
        dense, own = np.zeros(1 << BITS), row == p
        dense[col[own]] = val[own]
        near = np.bincount(row, weights=val * dense[col], minlength=len(words))
        parts[:, j] = (near - parts[:, :j] @ parts[p, :j]) / np.sqrt(left[p])
        left = np.maximum(left - parts[:, j] ** 2, 0.0)
        left[p] = 0.0
        out.append(words[p])
    return out


def look_alikes(bags: list[list[str]], marks: np.ndarray) -> dict[str, float]:
    """For every token, how far its look-alikes lean to other toxic documents.

    Tokens meet if they draw the same two kernel features (weighted min-hash); a token counts
    with the clearest of its ``BANDS`` meetings, in documents (signed root of the deviance).
    """
    words = sorted(set().union(*bags))
    place = {w: i for i, w in enumerate(words)}
    drawn = np.random.default_rng(13).exponential(size=(2 * BANDS, 1 << BITS))
    picks = np.zeros((2 * BANDS, len(words)), np.uint16)
    for lo in range(0, len(words), 4096):
        row, col, val = kernel_features(words[lo:lo + 4096])
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        sizes = np.diff(np.append(first, len(row)))
        for k, draw in enumerate(drawn):
            x = draw[col] / val
            hit = np.flatnonzero(x == np.repeat(np.minimum.reduceat(x, first), sizes))
            picks[k, lo + row[hit]] = col[hit]
    token = np.fromiter((place[w] for b in bags for w in b), np.int64)
    doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    rate, best = marks.mean(), np.full(len(words), -np.inf)
    for k in range(BANDS):
        group = np.unique(picks[2 * k].astype(np.int64) << BITS | picks[2 * k + 1], return_inverse=True)[1]
        held = np.unique(group[token] * len(bags) + doc)
        of, toxic = held // len(bags), marks[held % len(bags)]
        hits = np.bincount(of, weights=toxic)
        rest = np.bincount(of) - hits
        hits = np.maximum(hits - 1, 0.0)  # the token's own document
        n = np.maximum(hits + rest, 1.0)
        deviance = sum(x * np.log(np.maximum(x, 1.0) / (n * r)) for x, r in ((hits, rate), (rest, 1 - rate)))
        lean = np.sign(hits - n * rate) * np.sqrt(2 * np.maximum(deviance, 0.0))
        best = np.maximum(best, lean[group])
    return dict(zip(words, best.tolist(), strict=True))


def decisions(words: list[str], weight: np.ndarray, bias: float) -> np.ndarray:
    """SVM decision of every token (all landmarks folded into one weight vector)."""
    out = np.full(len(words), bias)
    for lo in range(0, len(words), 4096):
        part = words[lo:lo + 4096]
        row, col, val = kernel_features(part)
        out[lo:lo + len(part)] += np.bincount(row, weights=val * weight[col], minlength=len(part))
    return out


def _svm(x: np.ndarray, y: np.ndarray, c: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Linear SVM (squared hinge, weighted) by dual coordinate descent; the last feature is the bias."""
    rng = np.random.default_rng(7)
    x = np.hstack([x, np.ones((len(x), 1))])
    w, alpha, q = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(1)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            grad = y[i] * (x[i] @ w) - 1 + alpha[i] / (2 * c[i])
            new = max(alpha[i] - grad / (q[i] + 1 / (2 * c[i])), 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def evidence(scores: list[float]) -> tuple[float, float, float]:
    """What a document's token decisions say: the best, the second best, and how many speak for toxicity."""
    top = sorted((x for x in scores if x > -0.5), reverse=True)
    if len(top) < 2:
        top = sorted(scores, reverse=True)[:2] + [LOWEST, LOWEST]
    return top[0], top[1], math.log1p(sum(x > 0 for x in top))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights (the last is the constant) of a logistic curve: smoothed targets, Newton steps, a small ridge."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    z = np.column_stack([x, np.ones(len(x))])
    theta = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -35, 35)))
        h = z.T @ (z * (p * (1 - p))[:, None]) + ridge * np.eye(len(theta))
        step = np.linalg.solve(h, z.T @ (p - t) + ridge * theta)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return theta


def _singles(texts: list[str], alike: float = 0.5) -> list[int]:
    """Positions of the texts that are no near copy of an earlier one (MinHash of
    three-word shingles, checked by overlap)."""
    kept: dict[tuple[int, int], list[int]] = {}
    shingles: list[np.ndarray] = []
    out = []
    for i, text in enumerate(texts):
        words = text.split()
        many = max(1, len(words) - 2)
        own = np.unique(np.fromiter((zlib.crc32(" ".join(words[k:k + 3]).encode()) for k in range(many)), np.uint32, many))
        shingles.append(own)
        h = own.astype(np.uint64)
        bands = [(k, int(((h ^ np.uint64(0x5851F42D * (k + 1))) * np.uint64(0x9E3779B97F4A7C15)).min()))
                 for k in range(16)]
        near = {j for band in bands for j in kept.get(band, ())}
        shared = {j: len(np.intersect1d(own, shingles[j], assume_unique=True)) for j in near}
        if any(n >= alike * (len(own) + len(shingles[j]) - n) for j, n in shared.items()):
            continue
        out.append(i)
        for band in bands:
            kept.setdefault(band, []).append(i)
    return out


def train(texts: list[str], labels: list[int]) -> dict:
    """Fit on labelled texts: ``weight, bias`` of the machine, ``curve`` of the calibration.

    With one class only (or no text) the model is constant: the share of toxic texts.
    """
    y = np.array(labels, int)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.0
        p = min(max(share, 1e-6), 1 - 1e-6)
        return {"weight": np.zeros(1 << BITS), "bias": 0.0, "curve": np.array([0, 0, 0, np.log(p / (1 - p))])}
    # copies of a text would vouch for each other's rare tokens; a copy with the other label is a contrast
    single = sorted(rows[i] for rows in (np.flatnonzero(y == label) for label in (0, 1))
                    for i in _singles([texts[r] for r in rows]))
    known: dict[str, str] = {}  # one string object per token
    bags = [sorted(known.setdefault(w, w) for w in set().union(*map(units, sentences(texts[i])))) for i in single]
    marks_of = y[single]
    if len(set(marks_of.tolist())) < 2:
        return train([], [])
    pos, neg = Counter(), Counter()
    for bag, label in zip(bags, marks_of, strict=True):
        (pos if label else neg).update(bag)
    n_pos, n_neg = int(marks_of.sum()), int(len(marks_of) - marks_of.sum())

    def odds(w: str) -> float:
        return float(np.log((pos[w] + 0.5) / (n_pos + 1)) - np.log((neg[w] + 0.5) / (n_neg + 1)))

    rng = np.random.default_rng(11)
    clean = sorted(neg)
    common = [w for w, _ in sorted(neg.items(), key=lambda kv: (-kv[1], kv[0]))[:TOKENS // 4]]
    clean_tokens = list(dict.fromkeys(common + [clean[i] for i in rng.permutation(len(clean))[:TOKENS]]))
    watched = [clean[i] for i in rng.permutation(len(clean))[:WATCHED]]
    toxic = [b for b, label in zip(bags, marks_of, strict=True) if label and b]
    # tokens that many toxic documents share and clean ones do not
    rate = n_pos / (n_pos + n_neg)

    def surplus(w: str) -> float:
        n = pos[w] + neg[w]
        return (pos[w] - n * rate) / np.sqrt(n * rate * (1 - rate))

    shared = {w: n for w, n in pos.items() if n > 2 and surplus(w) >= CLEAR}
    # every other toxic document stands by one token, weighed by how clearly its look-alikes are toxic
    bare = [b for b in toxic if not shared.keys() & set(b)]
    unexplained = [b for b, label in zip(bags, marks_of, strict=True) if not label] + bare
    lean = look_alikes(unexplained, np.arange(len(unexplained)) >= n_neg) if bare else {}

    def with_bare(best) -> dict[str, float]:
        weight = {w: 1.0 + math.log1p(n) for w, n in shared.items()}
        for b in bare:
            w = max(b, key=lambda w: (best(w), w))
            weight[w] = weight.get(w, 0.0) + min(max(lean[w] / CLEAR, FAINT), 1.0) ** 2
        return weight

    witness = with_bare(lambda w: lean[w] + 0.25 * odds(w))
    model: dict = {}
    for _ in range(ROUNDS):
        good = sorted(witness, key=lambda w: (-witness[w], w))
        weights = np.array([witness[w] for w in good])
        clear = {w for w in good if odds(w) > 0}
        bad = [w for w in clean_tokens if w not in clear]
        words, target = good + bad, np.array([1.0] * len(good) + [-1.0] * len(bad))
        # landmarks: witnesses that differ, heavy ones first, and clean tokens, hard ones first
        chosen = spread(good, weights, LANDMARKS // 2)
        chosen = chosen + [w for w in bad if w not in set(chosen)][:LANDMARKS - len(chosen)]
        row, col, val = kernel_features(chosen)
        phi = np.zeros((1 << BITS, len(chosen)))
        phi[col, row] = val
        value, vector = np.linalg.eigh(phi.T @ phi + 1e-6 * np.eye(len(chosen)))
        root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
        weights = np.append(weights * max(1.0, 0.5 * len(bad) / max(weights.sum(), 1.0)), np.ones(len(bad)))
        w = _svm(landmark_kernel(words, phi) @ root, target, weights)
        model = {"weight": phi @ (root @ w[:-1]), "bias": float(w[-1])}
        # the machine names witnesses of documents that share none, look-alikes counting; clean tokens it takes for toxic join the negatives
        every = sorted(set().union(*bare, watched)) if bare else watched
        score = dict(zip(every, decisions(every, **model), strict=True))
        witness = with_bare(lambda w: score[w] + 0.25 * odds(w) + min(lean[w], CLEAR) / CLEAR)  # noqa: B023
        hard = sorted((t for t in watched if score[t] > -0.7), key=lambda t: (-score[t], t))
        clean_tokens = list(dict.fromkeys(hard + clean_tokens))[:2 * TOKENS]
    names = sorted(set().union(*bags))
    score = dict(zip(names, decisions(names, **model), strict=True))
    seen = np.array([evidence([score[t] for t in b]) for b in bags])
    return {**model, "curve": _logistic(seen, marks_of)}


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text leaves remainder 2 by 4 (null id: as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = TRAIN_DOCS) -> dict:
    """Train on at most ``sample`` labelled documents of each label outside the held-out fold.

    The sample is the first ``sample`` by a hash of the id: bounded, the same in
    every run, spread over all sources. It is the only thing collected.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")) \
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("y = 1").orderBy(*order).limit(sample).unionAll(
        known.where("y = 0").orderBy(*order).limit(sample))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(picked), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))  # repeated ids count once
    rows = {r.doc_id: (r.text or "", r.y) for r in one.toLocalIterator()}
    keys = sorted(rows)
    return train([rows[k][0] for k in keys], [rows[k][1] for k in keys])


_cache: dict = {}


def _seen(model_id) -> dict[str, float]:
    """The worker's token scores under one model (kept from task to task)."""
    if _cache.get("model") != model_id:
        _cache.update(model=model_id, scores={})
    return _cache["scores"]


def _scorer(shared):
    """Scores of the texts of one Arrow column, in a worker."""
    model = shared.value
    seen = _seen(model["id"])

    def score(texts: pa.Array) -> np.ndarray:
        found = []
        for text in texts.cast(pa.large_string()).to_pylist():
            bag = units(text) if text else set()
            missing = bag.difference(seen)
            if missing:
                if len(seen) + len(missing) > CACHE:
                    seen.clear()
                    missing = bag
                missing = list(missing)
                seen.update(zip(missing, decisions(missing, model["weight"], model["bias"]).tolist(), strict=True))
            found.append(evidence(list(map(seen.__getitem__, bag))))
        z = np.array(found, float).reshape(-1, 3) @ model["curve"][:-1] + model["curve"][-1]
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))

    return score


def _broadcast(docs: DataFrame, model: dict):
    return docs.sparkSession.sparkContext.broadcast(model | {"id": uuid.uuid4().hex})


def score_texts(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` (0..1) of every row; null and blank texts score lowest."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = _broadcast(docs, model)

    def run(batches):
        score = _scorer(shared)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score(b.column(1)), pa.float64())],
                                             ["doc_id", "score"])

    return on_workers(src).mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, model: dict, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``threshold`` (filtered where they lie).

    Null and empty texts score as texts without words; repeated rows stay or go alike; an empty table gives an empty result.
    """
    shared, place = _broadcast(docs, model), docs.columns.index(text_col)

    def run(batches):
        score = _scorer(shared)
        for b in batches:
            yield b.filter(pa.array(score(b.column(place)) < threshold))

    return on_workers(docs).mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", threshold: float = THRESHOLD, sample: int = TRAIN_DOCS) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    ``predicted`` is 1 if ``score >= threshold``. Only texts enter the score;
    labels are learnt outside the held-out fold. Null and blank texts get the
    lowest score; null ids are scored (and never trained on); repeated rows
    score alike; without labels of both kinds every score is the share of toxic
    ones; an empty table gives an empty result; other columns are ignored.
    """
    model = fit(docs, labels, id_col, text_col, label_col, sample)
    scored = score_texts(docs, model, id_col, text_col)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= F.lit(threshold)).cast("int").alias("predicted"))
