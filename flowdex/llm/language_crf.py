"""Language identification by a linear-chain conditional random field over the words of a text.

Each word gets a score for every language from hashed affix and character n-gram features and from a lexicon; learned
transitions tie neighbouring words; forward-backward gives every word its probability of each language, so mixed text is
labelled word by word.  A text's language is the one with the largest mean probability.

Learning takes a bounded sample of labelled rows, chosen by a hash: ``SAMPLE_PER_LANG`` texts of each label, fewer where
there are so many labels that ``SAMPLE_ROWS`` is reached, and of each text, however long, up to ``SAMPLE_CHAINS`` chains
spread over it.  Every label is learned.  Learning runs on the driver; prediction reads every whole text where it lies,
without a shuffle.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowdex.llm.common import table, text_batches, values

UNDETERMINED = "und"
SAMPLE_PER_LANG = 400     # labelled texts per language that learning reads, at most about
SAMPLE_ROWS = 40_000      # labelled texts that learning reads in all, at most about
SAMPLE_CHAINS = 32        # chains of one text that learning reads
LEARN_CHAINS = 12_000     # chains that learning passes over, about: each language the same number
LONGEST = 24              # letters of a word; a longer run of letters is several words
CHAIN = 64                # words of a chain; a longer text is several chains
BUCKET_BITS = 15          # hashed features
BUCKETS = 1 << BUCKET_BITS
LEXICON_COUNT = 3         # sample count from which a word enters the lexicon
EPOCHS, BATCH, RATE, DECAY = 2, 256, 0.3, 1e-5
SPLICED = 0.3             # share of learning chains joined from two languages, for transitions between languages
WORD_CACHE = 150_000      # words whose scores a task keeps; the cache restarts beyond it
GROUP_WORDS = 60_000      # words scored at a time
LEAST = 0.2               # certainty from which the language of a text is told


def _other_numbers() -> str:
    """A character class of what Python takes for alphanumeric that is neither a letter nor a digit: raised, circled..."""
    ranges: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)) in ("No", "Nl"):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges) + "]"


OTHER_NUMBERS = re.compile(_other_numbers())
WORD = re.compile(r"[^\W\d_]{1,%d}" % LONGEST)


def words_of(text: str | None) -> list[str]:
    """Lower-case words: runs of letters, those of more than ``LONGEST`` cut into several."""
    if not text:
        return []
    text = text.lower()
    # Two classes are quicker than one that holds both: the first is a bitmap, and most texts have none of it.
    if not text.isascii() and OTHER_NUMBERS.search(text):
        text = OTHER_NUMBERS.sub(" ", text)
    return WORD.findall(text)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets ``(words, features)`` and which of them count: n-grams of one to three characters of the word between
    marks, and its prefix and suffix of four characters."""
    marked = [f"^{w}$".ljust(26, "\0") for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").reshape(len(words), 26).astype(np.uint64)
    length = (codes > 0).sum(axis=1)
    k1, k2, k3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    two = codes[:, :-1] * k1 + codes[:, 1:] * k2
    three = two[:, :-1] + codes[:, 2:] * k3
    row = np.arange(len(words))
    tail = np.maximum(length - 5, 0)
    ends = [three[:, 1] * k1 + codes[:, 4] + np.uint64(1), three[row, tail] * k1 + codes[row, tail + 3] + np.uint64(2)]
    every = np.concatenate([codes[:, 1:-1] * k3 + np.uint64(3), two + np.uint64(4), three + np.uint64(5),
                            np.stack(ends, 1)], axis=1)
    every ^= every >> np.uint64(29)
    every *= np.uint64(0xBF58476D1CE4E5B9)
    at = np.arange(26)[None, :]
    used = np.concatenate([at[:, 1:-1] < length[:, None] - 1, at[:, 1:] < length[:, None], at[:, 2:] < length[:, None],
                           np.ones((len(words), 2), bool)], axis=1)
    return (every >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), used


class Model:
    """Learned weights: hashed features, lexicon, transitions and chain starts."""

    def __init__(self, langs: list[str], lexicon: dict[str, np.ndarray]):
        n = len(langs)
        self.langs, self.lexicon = langs, lexicon
        self.weights = np.zeros((BUCKETS, n), np.float32)
        self.lexical = np.zeros((n, n), np.float32)
        self.transition = np.zeros((n, n), np.float32)
        self.start = np.zeros(n, np.float32)

    def tables(self, words: list[str]):
        """(buckets, their shares, lexicon rows) of distinct words; the shares of a word have length one."""
        buckets, used = word_features(words)
        none = np.zeros(len(self.langs), np.float32)
        lexical = np.array([self.lexicon.get(w, none) for w in words], np.float32).reshape(len(words), len(none))
        return buckets, used / np.sqrt(used.sum(axis=1, keepdims=True)).astype(np.float32), lexical

    def scores(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.langs)), np.float32)
        for i in range(0, len(words), 8192):
            buckets, share, lexical = self.tables(words[i:i + 8192])
            part = out[i:i + 8192]
            for f in range(buckets.shape[1]):
                live = np.flatnonzero(share[:, f])
                part[live] += self.weights[buckets[live, f]] * share[live, f, None]
            part += lexical @ self.lexical
        return out


def forward_backward(emit: np.ndarray, length: np.ndarray, model: Model):
    """Word probabilities ``(chains, words, langs)`` and expected transitions of padded chains.

    ``emit`` holds the scores of the words, ``length`` the words of each chain (at least one).  Forward and backward
    values are scaled at each word, so no chain under- or overflows.
    """
    chains, steps, n = emit.shape
    move = np.exp(model.transition.astype(np.float64))
    at = np.exp(emit - emit.max(axis=2, keepdims=True)).astype(np.float64) + 1e-12
    live = np.arange(steps)[None, :] < length[:, None]
    forward = np.empty((steps, chains, n))
    scale = np.ones((steps, chains))
    now = np.exp(model.start.astype(np.float64))[None, :] * at[:, 0]
    for t in range(steps):
        if t:
            step = (now @ move) * at[:, t]
            now = np.where(live[:, t, None], step, now)
        scale[t] = now.sum(axis=1)
        now = now / scale[t][:, None]
        forward[t] = now
    back = np.ones((chains, n))
    prob = np.empty((chains, steps, n))
    moves = np.zeros((n, n))
    for t in range(steps - 1, -1, -1):
        joint = forward[t] * back
        prob[:, t] = joint / joint.sum(axis=1, keepdims=True)
        if t:
            carried = at[:, t] * back
            pair = forward[t - 1][:, :, None] * move[None] * carried[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            moves += pair[live[:, t]].sum(axis=0)
            step = carried @ move.T
            back = np.where(live[:, t, None], step / step.sum(axis=1, keepdims=True), back)
    return prob, moves


def _marginals(emit: np.ndarray, length: np.ndarray, model: Model) -> np.ndarray:
    """Word probabilities alone (as ``forward_backward``, in single precision)."""
    chains, steps, n = emit.shape
    move = np.exp(model.transition)
    at = np.exp(np.maximum(emit - emit.max(axis=2, keepdims=True), -60)).transpose(1, 0, 2)
    live = (np.arange(steps)[:, None] < length[None, :])[:, :, None]
    forward = np.empty((steps, chains, n), np.float32)
    now = np.exp(model.start)[None, :] * at[0]
    for t in range(steps):
        if t:
            now = np.where(live[t], (now @ move) * at[t], now)
        now = now / now.sum(axis=1, keepdims=True)
        forward[t] = now
    back = np.ones((chains, n), np.float32)
    prob = np.empty((chains, steps, n), np.float32)
    for t in range(steps - 1, -1, -1):
        joint = forward[t] * back
        prob[:, t] = joint / np.maximum(joint.sum(axis=1, keepdims=True), 1e-30)
        if t:
            step = (at[t] * back) @ move.T
            back = np.where(live[t], step / np.maximum(step.sum(axis=1, keepdims=True), 1e-30), back)
    return prob


def fit(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """Learn from whole texts and their labels by stochastic gradient ascent of the chains' likelihood."""
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    chains, counts = [], {}
    for text, label in zip(texts, labels):
        words = words_of(text)
        k = langs.index(label)
        for w in words:
            counts.setdefault(w, np.zeros(len(langs), np.float32))[k] += 1
        chains += [([*words[i:i + CHAIN]], k) for i in range(0, len(words), CHAIN)]
    totals = sum(counts.values(), np.zeros(len(langs), np.float32)) + 1
    lexicon = {}
    for w, c in counts.items():
        if c.sum() >= LEXICON_COUNT:
            share = (c + 0.1) / totals
            lexicon[w] = share / share.sum() - 1 / len(langs)
    model = Model(langs, lexicon)
    if len(langs) < 2 or not chains:
        return model
    by_lang: list[list] = [[] for _ in langs]
    for c in chains:
        by_lang[c[1]].append(c)
    # Every language gives the same number of chains, drawn at random and repeated, so none wins by frequency alone.
    most = min(max(map(len, by_lang)), max(60, LEARN_CHAINS // len(langs)))
    balanced = []
    for group in by_lang:
        if group:
            drawn = rng.permutation(len(group))[:most]
            balanced += [group[drawn[i % len(drawn)]] for i in range(most)]
    sequences = []
    for words, k in balanced:
        tags = [k] * len(words)
        if rng.random() < SPLICED:
            other, j = balanced[rng.integers(len(balanced))]
            cut = int(rng.integers(1, len(words) + 1))
            words, tags = (words[:cut] + other)[:CHAIN], (tags[:cut] + [j] * len(other))[:CHAIN]
        sequences.append((words, tags))
    vocabulary = {w: i for i, w in enumerate(sorted({w for ws, _ in sequences for w in ws}))}
    buckets, share, lexical = model.tables(list(vocabulary))
    squares = [np.full(x.shape, 1e-6, np.float32) for x in (model.weights, model.lexical, model.transition, model.start)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(sequences))
        for first in range(0, len(order), BATCH):
            part = [sequences[i] for i in order[first:first + BATCH]]
            length = np.array([len(w) for w, _ in part])
            ids = np.zeros((len(part), CHAIN), np.int64)
            tags = np.zeros((len(part), CHAIN), np.int64)
            for i, (w, y) in enumerate(part):
                ids[i, :len(w)] = [vocabulary[x] for x in w]
                tags[i, :len(y)] = y
            distinct, place = np.unique(ids, return_inverse=True)
            place = place.reshape(ids.shape)
            score = (np.einsum("vfl,vf->vl", model.weights[buckets[distinct]], share[distinct])
                     + lexical[distinct] @ model.lexical)
            prob, moves = forward_backward(score[place], length, model)
            live = np.arange(CHAIN)[None, :] < length[:, None]
            wrong = -prob
            np.put_along_axis(wrong, tags[:, :, None],
                              np.take_along_axis(wrong, tags[:, :, None], 2) + 1, 2)
            wrong *= live[:, :, None]
            per_word = np.zeros((len(distinct), len(langs)))
            np.add.at(per_word, place[live], wrong[live])
            seen = np.zeros((len(langs), len(langs)))
            both = live[:, 1:]
            np.add.at(seen, (tags[:, :-1][both], tags[:, 1:][both]), 1)
            words = live.sum()
            grad_w = np.zeros_like(model.weights, dtype=np.float64)
            flat = buckets[distinct].ravel()
            pushed = (share[distinct][:, :, None] * per_word[:, None, :]).reshape(len(flat), -1)
            for k in range(len(langs)):
                grad_w[:, k] = np.bincount(flat, pushed[:, k], BUCKETS)
            grads = (grad_w / words, lexical[distinct].T @ per_word / words, (seen - moves) / words,
                     wrong[:, 0].sum(axis=0) / words)
            for x, g, q in zip((model.weights, model.lexical, model.transition, model.start), grads, squares):
                g = (g - DECAY * x).astype(np.float32)
                q += g * g
                x += RATE * g / np.sqrt(q)
    return model


class Labeller:
    """Scores texts with a model; keeps the scores of the words it has met."""

    def __init__(self, model: Model):
        self.model, self.index, self.known = model, {}, np.empty((0, len(model.langs)), np.float32)

    def _scores(self, words: list[str]) -> np.ndarray:
        index = self.index
        try:
            at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        except KeyError:
            if len(index) > WORD_CACHE:
                index.clear()
                self.known = self.known[:0]
            new = list(dict.fromkeys(w for w in words if w not in index))
            self.known = np.concatenate([self.known, self.model.scores(new)])
            for w in new:
                index[w] = len(index)
            at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        return self.known[at]

    def __call__(self, texts: list[list[str]]):
        """Word probabilities of texts given as lists of words, one array each."""
        n = len(self.model.langs)
        sizes = [len(t) for t in texts]
        total = sum(sizes)
        if not total:
            return [np.empty((0, n), np.float32) for _ in texts]
        score = self._scores([w for t in texts for w in t])
        # Position of each word in its padded chain.
        counts = np.array(sizes)
        inner = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        chains = -(-counts // CHAIN)
        row = np.repeat(np.cumsum(chains) - chains, counts) + inner // CHAIN
        length = np.bincount(row, minlength=int(chains.sum()))
        emit = np.zeros((len(length), int(min(CHAIN, counts.max())), n), np.float32)
        emit[row, inner % CHAIN] = score
        prob = _marginals(emit, length, self.model)[row, inner % CHAIN]
        return np.split(prob, np.cumsum(counts)[:-1])


def held_out(id_col: Column) -> Column:
    """Rows never learned from: crc32 of the id's text divisible by 5, and rows without id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from the rows that aren't held out and have a label and a text; see the module text for the bounds."""
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
            .filter(F.col("lang").isNotNull() & ~held_out(F.col("id")) & F.col("text").isNotNull()))
    # One row per label comes to the driver.
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], {})
    each = max(1, min(SAMPLE_PER_LANG, SAMPLE_ROWS // len(counts)))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_003)) / 1_000_003
    # Rare labels are read whole; a frequent one's share is that of its rows.
    frequent = {lang: each / n for lang, n in counts.items() if n > each}
    share = F.lit(1.0)
    if frequent:
        shares = F.create_map(*[F.lit(x) for kv in frequent.items() for x in kv])
        share = F.coalesce(F.try_element_at(shares, F.col("lang")), F.lit(1.0))

    def chains(batches):
        for batch in batches:
            texts = []
            for text in values(batch.column(1)):
                words = words_of(text)
                n = -(-len(words) // CHAIN)
                if n > SAMPLE_CHAINS:  # chains spread evenly over the text
                    at = [k * n // SAMPLE_CHAINS * CHAIN for k in range(SAMPLE_CHAINS)]
                    words = [w for a in at for w in words[a:a + CHAIN]]
                texts.append(" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), batch.column(2)],
                                             names=["draw", "text", "lang"])

    sample = (text_batches(rows.filter(draw < share)).select(F.xxhash64("id", "text").alias("draw"), "text", "lang")
              .mapInArrow(chains, "draw long, text string, lang string").limit(2 * each * len(counts) + 1000)
              .toPandas().sort_values(["draw", "text"], kind="stable"))
    return fit(sample["text"].tolist(), sample["lang"].tolist())


def _groups(texts):
    """Lists of words of the texts, in groups of about ``GROUP_WORDS`` words."""
    group, size = [], 0
    for text in texts:
        words = words_of(text)
        group.append(words)
        size += len(words)
        if size >= GROUP_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``held_out``, ``lang_pred``, ``score`` for every row.

    ``score`` is the mean probability of ``lang_pred`` over the words.  A text that is null or has no letter (or any
    text, if nothing could be learned) is ``und`` with score 0; ties go to the first language by name.
    """

    def run(batches):
        label = Labeller(model)
        for batch in batches:
            names, scores = [], []
            for group in _groups(values(batch.column(2))):
                if not model.langs:
                    names += [UNDETERMINED] * len(group)
                    scores += [0.0] * len(group)
                    continue
                for prob in label(group):
                    if not len(prob):
                        names.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    mean = prob.mean(axis=0, dtype=np.float64)
                    best = int(mean.argmax())
                    names.append(model.langs[best])
                    scores.append(min(1.0, float(mean[best])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["id", "held_out", "lang_pred", "score"])

    src = text_batches(docs).select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"),
                      F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double")
            .withColumnRenamed("id", id_col))


def label_words(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``words``: ``(word, lang, probability)`` of each lower-case word in order; none for texts without letters."""

    def run(batches):
        label = Labeller(model)
        for batch in batches:
            out = []
            for group in _groups(values(batch.column(1))):
                for words, prob in zip(group, label(group)):
                    best = prob.argmax(axis=1) if len(prob) else []
                    out.append([{"word": w, "lang": model.langs[k], "probability": float(p[k])}
                                for w, k, p in zip(words, best, prob)])
            kind = pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("probability", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["id", "words"])

    src = text_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(run, f"id {kind}, words array<struct<word:string,lang:string,probability:double>>")
            .withColumnRenamed("id", id_col))


def certainty(prob: np.ndarray) -> float:
    """How surely the words of a text are told: their mean largest probability, 0 where all languages are alike, 1 at most.

    A text in several languages is sure where each of its words is.
    """
    chance = 1 / prob.shape[1]
    return 1.0 if chance == 1 else max(0.0, float((prob.max(axis=1).mean(dtype=np.float64) - chance) / (1 - chance)))


def identified(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """``docs`` without rows whose language can't be told: null, without a letter, or of words with a ``certainty`` under
    ``least``.  A row without a label gets the predicted one; all other values are as they were.

    Where no row is labelled nothing can be judged: every text with a letter stays, without a label.  Predictions carry
    each row along, so repeated ids don't matter.
    """
    model = learn(docs, id_col, text_col, lang_col)
    fills = isinstance(docs.schema[lang_col].dataType, T.StringType)

    def run(batches):
        label = Labeller(model)
        for batch in batches:
            keep, names = [], []
            at = batch.schema.get_field_index(lang_col)
            for group in _groups(values(batch.column(batch.schema.get_field_index(text_col)))):
                if not model.langs:
                    keep += [len(words) > 0 for words in group]
                    continue
                for p in label(group):
                    keep.append(len(p) > 0 and certainty(p) >= least)
                    names.append(model.langs[int(p.mean(axis=0, dtype=np.float64).argmax())] if len(p) else None)
            if model.langs and fills:
                told = pc.coalesce(batch.column(at), pa.array(names, batch.schema.field(at).type))
                batch = pa.RecordBatch.from_arrays([told if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return text_batches(docs).mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learn(docs))
