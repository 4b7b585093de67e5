"""Language ID by multilingual mixture inference (operator 5).

Each language is a smoothed distribution over hashed byte trigrams, counted
over all training rows. A document is a mixture of languages: expectation
maximisation estimates the proportions from its trigram likelihoods, and the
language set grows one language at a time while the likelihood gained exceeds
a penalty by the logarithm of the document's length. The prediction is the
language with the largest proportion in the selected set (ties: the first by
name), its score that proportion.

The model has one row of ``BINS`` numbers a language; more than
``MAX_LANGUAGES`` label values raise an error, which bounds it.

Rows: null text and text without a letter get ``und`` and score 0, so does
every text when nothing was learned; rows with a null label don't train;
repeated rows count as often as they occur; an empty table gives an empty
result. Only the text is looked at to predict.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.textbatch import LOWER, chunks, lean, utf8

BINS = 1 << 14
MAX_LANGUAGES = 1000
STEPS = 12
PENALTY = 3.0
SMOOTH = 0.5
UNKNOWN = "und"
#: A language whose share in the full mixture is below this can't gain enough.
LEAST_SHARE = 0.02

# Letters in lower case, other ASCII as a blank, other bytes as they are.
_FOLD = LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bin of every trigram within a row, blanks left out."""
    d = _FOLD[data].astype(np.uint32)
    if len(d) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = d[:-2] << np.uint32(16) | d[1:-1] << np.uint32(8) | d[2:]
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    good = (row[:-2] == row[2:]) & ((d[:-2] != 32) | (d[1:-1] != 32)) & ((d[1:-1] != 32) | (d[2:] != 32))
    bins = (code[good] * np.uint32(2654435761)) >> np.uint32(32 - 14)
    return row[:-2][good], bins.astype(np.int64)


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    def rows(mask):
        c = np.concatenate([[0], np.cumsum(mask)])
        return c[off[1:]] > c[off[:-1]]
    found = rows((LOWER[data] >= 97) & (LOWER[data] <= 122))
    for r in np.flatnonzero(~found & rows(data >= 128)):
        found[r] = any(c.isalpha() for c in data[off[r]:off[r + 1]].tobytes().decode("utf-8", "replace"))
    return found


def train(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages by name and their log-probabilities, from (lang, text)."""
    def run(batches):
        counts: dict[str, np.ndarray] = {}

        def told():
            for lang, c in counts.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                                  pa.array(c[at])], names=["lang", "bin", "n"])
            counts.clear()

        for b in batches:
            code = b.column(0).dictionary_encode()
            names, label = code.dictionary.to_pylist(), code.indices.to_numpy(zero_copy_only=False)
            data, off = utf8(b.column(1))
            for lo, hi in chunks(off):
                row, bins = trigrams(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                own = label[lo:hi][row]
                for k in np.unique(own):
                    c = np.bincount(bins[own == k], minlength=BINS)
                    counts[names[k]] = counts[names[k]] + c if names[k] in counts else c
                if len(counts) > 100:
                    yield from told()
        yield from told()

    table = (rows.mapInArrow(lean(run), "lang string, bin int, n long")
             .groupBy("lang", "bin").agg(F.sum("n").alias("n")))
    # One array a language, bins included, so the driver gets at most MAX_LANGUAGES rows of BINS numbers.
    each = (table.groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("cells"))
            .limit(MAX_LANGUAGES + 1).toArrow())
    if each.num_rows > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = each.column("lang").to_pylist()
    counts = np.zeros((len(names), BINS))
    for i, cells in enumerate(each.column("cells")):
        flat = cells.values
        counts[i, flat.field("bin").to_numpy()] = flat.field("n").to_numpy()
    order = sorted(range(len(names)), key=lambda i: names[i])
    counts = counts[order] + SMOOTH
    return [names[i] for i in order], np.log(counts / counts.sum(1, keepdims=True))


def _em(p: np.ndarray, n: np.ndarray, start: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihoods by row. ``p``: entries x languages
    likelihoods; entries are sorted by row, ``start`` has their first."""
    size = np.diff(np.append(start, len(n)))
    total = np.add.reduceat(n, start)
    for step in range(STEPS + 1):
        w = p * np.repeat(share, size, axis=0)
        s = w.sum(1)
        if step == STEPS:
            return share, np.add.reduceat(n * np.log(s), start)
        share = np.add.reduceat(w * (n / s)[:, None], start) / total[:, None]


def infer(data: np.ndarray, off: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best language (-1: none) and its proportion for every row."""
    n_rows, n_lang = len(off) - 1, len(logp)
    best, score = np.full(n_rows, -1), np.zeros(n_rows)
    row, bins = trigrams(data, off)
    if not len(row) or not n_lang:
        return best, score
    key, n = np.unique(row * BINS + bins, return_counts=True)
    row, bins, n = key // BINS, key % BINS, n.astype(float)
    start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    rows = row[start]
    single = np.add.reduceat(n[:, None] * logp.T[bins], start)
    first = single.argmax(1)
    best[rows], score[rows] = first, 1.0
    if n_lang == 1:
        return best, score
    p = np.exp(logp).T[bins]
    share, _ = _em(p, n, start, np.full((len(rows), n_lang), 1.0 / n_lang))
    length = np.add.reduceat(n, start)
    # The set grows by the largest remaining share, as long as it pays.
    share[np.arange(len(rows)), first] += 2  # the best single language comes first
    order = np.argsort(-share, axis=1, kind="stable")
    share[np.arange(len(rows)), first] -= 2
    chosen = np.zeros((len(rows), n_lang), bool)
    chosen[np.arange(len(rows)), first] = True
    reached = single[np.arange(len(rows)), first]
    size = np.diff(np.append(start, len(n)))
    open_ = np.ones(len(rows), bool)
    for k in range(1, n_lang):
        cand = order[:, k]
        open_ &= share[np.arange(len(rows)), cand] > LEAST_SHARE
        at = np.flatnonzero(open_)
        if not len(at):
            break
        trial = chosen[at].copy()
        trial[np.arange(len(at)), cand[at]] = True
        entry = np.repeat(open_, size)
        s = np.cumsum(size[at]) - size[at]
        init = np.where(trial, np.maximum(share[at], 1e-3), 0.0)
        got, ll = _em(p[entry], n[entry], s, init / init.sum(1, keepdims=True))
        pays = ll - reached[at] > PENALTY * np.log(length[at] + 1)
        win = at[pays]
        chosen[win], reached[win] = trial[pays], ll[pays]
        top = got[pays].argmax(1)
        best[rows[win]], score[rows[win]] = top, got[pays][np.arange(len(win)), top]
        open_[at[~pays]] = False
    return best, np.clip(score, 0.0, 1.0)


def held_out(id_col: Column) -> Column:
    """Rows that training leaves out, by the CRC-32 of the id's text."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def fitted(docs: DataFrame, id_col: str, text_col: str, lang_col: str):
    own = docs.filter(~held_out(docs[id_col]) & docs[lang_col].isNotNull() & docs[text_col].isNotNull())
    return train(own.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text")))


def _predict(column, names, logp):
    data, off = utf8(column)
    best, score = np.full(len(off) - 1, -1), np.zeros(len(off) - 1)
    for lo, hi in chunks(off, 1 << 19):
        d, o = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        b, s = infer(d, o, logp)
        known = has_letter(d, o) & (len(names) > 0)
        # a text too short for a trigram has a letter: the first language
        b = np.where(known & (b < 0), 0, b)
        best[lo:hi], score[lo:hi] = np.where(known, b, -1), np.where(known, s, 0.0)
    return best, score


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(fitted(docs, id_col, text_col, lang_col))
    src = docs.select(docs[id_col].alias("id"), held_out(docs[id_col]).alias("held_out"),
                      docs[text_col].alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        names, logp = sent.value
        labels = np.array([*names, UNKNOWN], object)
        for b in batches:
            best, score = _predict(b.column(2), names, logp)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(labels[best], pa.string()),
                                              pa.array(score)], names=[id_col, "held_out", "lang_pred", "score"])

    return src.mapInArrow(lean(run), f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")


def keep_languages(docs: DataFrame, languages: tuple[str, ...] | None, least: float, id_col: str = "doc_id",
                   text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows of ``docs``, all columns kept, whose predicted language is one of
    ``languages`` (None: any learned one) with at least this score."""
    sent = docs.sparkSession.sparkContext.broadcast(fitted(docs, id_col, text_col, lang_col))
    at = docs.columns.index(text_col)

    def run(batches):
        names, logp = sent.value
        wanted = np.array([languages is None or n in languages for n in names] + [False], bool)
        for b in batches:
            best, score = _predict(b.column(at), names, logp)
            keep = wanted[best] & (score >= least)
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(lean(run), docs.schema)
