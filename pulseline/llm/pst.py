"""Language-model scoring with a probabilistic suffix tree.

The model's symbols are the bytes of a text's words, joined by single spaces,
and an end.  Contexts of up to ``DEPTH`` bytes are counted over all training
texts by an aggregation of (DEPTH + 1)-grams.  A context is a candidate if it
occurs at least ``MIN_COUNT`` times, whatever the size of the corpus; it is
retained if its next-symbol distribution diverges from that of its longest
proper suffix, tested with each occurrence left out of its own count, so that
chance patterns of rare contexts fail.  Distributions are smoothed towards the
suffix's, down to uniform bytes.

What the tree says of a symbol depends on its (DEPTH + 1)-gram only.  So the
tree is never in one place: its levels are tables of grams, each joined with
the level of its suffixes, and the last one has the log probability of every
gram of all texts.  Grams that make up a share of at least 2^-GRAM_HEAD_BITS
of all symbols (so at most 2^GRAM_HEAD_BITS of them, 16 bytes each) are broadcast;
all others meet their probabilities in a join.

Word counts are kept whole.  Words that make up a share of at least
2^-HEAD_BITS of all tokens (so at most 2^HEAD_BITS of them) are broadcast; all
others meet their counts in a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseline.llm.common import SPACES, ascii_lower, byte_slices, split_words, table, text_buffer
from pulseline.session import materialize

DEPTH = 5
MIN_COUNT = 20
MIN_GAIN = 10.0
GAIN_PER_SYMBOL = 0.01
HEAD_BITS = 20
GRAM_HEAD_BITS = 21
HEAD_WORD_BYTES = 64
SLICE_BYTES = 2 << 20
SPACE, END = 32, 10  # both are white space, so no word has them


def stream(text: bytes) -> tuple[bytes, list[bytes]]:
    """The symbols of a text (without its end) and its words."""
    words = text.lower().split()
    return b" ".join(words), words


# --- counting -----------------------------------------------------------------

def _grams(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(DEPTH+1)-gram of every symbol, as an integer, and the number of its
    line; END pads the start."""
    if not lines:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pad = bytes([END]) * DEPTH
    data = np.frombuffer(b"".join(pad + x + bytes([END]) for x in lines), np.uint8)
    n = len(data) - DEPTH
    out = np.zeros(n, np.int64)
    for k in range(DEPTH + 1):
        out <<= 8
        out |= data[k:k + n]
    size = np.array([len(x) + 1 for x in lines], np.int64)
    starts = np.r_[0, np.cumsum(size + DEPTH)[:-1]]
    real = np.ones(n, bool)  # a gram that ends in another line's padding is none
    ends = starts[1:]
    for k in range(1, DEPTH + 1):
        real[ends - k] = False
    return out[real], np.repeat(np.arange(len(size), dtype=np.int32), size)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n, uses): how often training texts and all texts have it, in
    each slice of the texts.  Spark's partial aggregate adds the slices up,
    so a task holds one slice of texts and its grams at a time."""
    for batch in batches:
        data, offsets = text_buffer(batch.column(0))
        held = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for first, last in byte_slices(offsets, SLICE_BYTES):
            raw = data[offsets[first]:offsets[last]].tobytes()
            cut = (offsets[first:last + 1] - offsets[first]).tolist()
            grams, line = _grams([stream(raw[a:b])[0] for a, b in zip(cut, cut[1:])])
            # a gram takes 48 bits; the lowest bit tells held-out texts from training texts
            keys, n = np.unique(grams << 1 | held[first:last][line], return_counts=True)
            new = np.flatnonzero(np.r_[True, keys[1:] >> 1 != keys[:-1] >> 1][:len(keys)])
            if len(new):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[new] >> 1), pa.array(np.add.reduceat(np.where(keys & 1, 0, n), new)),
                     pa.array(np.add.reduceat(n, new))], ["gram", "n", "uses"])


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n, uses) of ``texts`` (text, held_out), a written table."""
    counts = texts.select("text", "held_out").mapInArrow(_count, "gram long, n long, uses long")
    return materialize(counts.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses")), "grams")


def _last(gram: Column, n: int) -> Column:
    """The last n bytes of a gram."""
    return gram.bitwiseAND(F.lit((1 << 8 * n) - 1)) if n < 8 else gram


# --- the tree as tables -------------------------------------------------------

def gram_scores(grams: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(gram, uses, log): log10 probability of the last symbol of each of
    ``grams`` after its longest retained context, a written table.

    The level of depth d has the grams of d + 1 bytes.  Its rows meet those
    of their suffixes by a join; the rows of a context, at most 256, make one
    window.
    """
    levels = [grams]
    for d in reversed(range(DEPTH)):
        levels.insert(0, materialize(levels[0].groupBy(_last(F.col("gram"), d + 1).alias("gram")).agg(
            F.sum("n").alias("n")), "level"))
    w = Window.partitionBy("context")
    n, size, kinds, below = map(F.col, ("n", "size", "kinds", "below"))
    left_out = (n - 1 + kinds * below) / (size - 1 + kinds)
    known = None
    for d, level in enumerate(levels):
        if known is None:
            x = level.withColumns({"below": F.lit(1 / 256), "best": F.lit(1 / 256)})
        else:
            x = level.withColumn("suffix", _last(F.col("gram"), d)).join(known, "suffix").drop("suffix")
        x = x.withColumn("context", F.shiftrightunsigned("gram", 8))
        x = x.withColumns({"size": F.sum("n").over(w), "kinds": F.count_if(n > 0).over(w)})
        x = x.withColumn("gain", F.sum(F.when((n > 0) & (size >= min_count), n * F.log(left_out / below))).over(w))
        kept = (size > 0) if d == 0 else (size >= min_count) & (
            F.col("gain") >= F.greatest(F.lit(MIN_GAIN), GAIN_PER_SYMBOL * size))
        # of a context that is no candidate the chance is read by none
        x = x.withColumn("chance", F.when(size > 0, (n + kinds * below) / (size + kinds)).otherwise(below))
        x = x.withColumn("best", F.when(kept, F.col("chance")).otherwise(F.col("best")))
        known = x.select(F.col("gram").alias("suffix"), F.col("chance").alias("below"), "best")
    return materialize(x.select("gram", "uses", F.log10("best").alias("log")), "logs")


# --- the operator -------------------------------------------------------------

def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all words, a written table."""
    words = texts.select(F.explode(split_words(ascii_lower(F.col("text")), SPACES)).alias("word"))
    return materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")


def _gram_logs(lines: list[bytes], keys: np.ndarray, logs: np.ndarray):
    """What the head grams say of each line, and the other grams: their
    number by line, themselves and how often the line has them."""
    grams, line = _grams(lines)
    order = np.argsort(grams)
    grams, line = grams[order], line[order]
    new = np.r_[True, grams[1:] != grams[:-1]][:len(grams)]
    some = grams[new]
    at = np.minimum(np.searchsorted(keys, some), max(len(keys) - 1, 0))
    hit = keys[at] == some if len(keys) else np.zeros(len(some), bool)
    which = np.cumsum(new) - 1
    found = np.zeros(len(some))
    found[hit] = logs[at[hit]]
    score = np.bincount(line, weights=found[which], minlength=len(lines))
    rest = ~hit[which]
    grams, line = grams[rest], line[rest]
    order = np.argsort(line, kind="stable")  # by gram within a line
    grams, line = grams[order], line[order]
    first = np.flatnonzero(np.r_[True, (grams[1:] != grams[:-1]) | (line[1:] != line[:-1])][:len(grams)])
    return (score, np.bincount(line[first], minlength=len(lines)), grams[first],
            np.diff(np.r_[first, len(grams)]))


def _score(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: tokens, what the head grams and head words say of it, and the
    other grams and words with their counts."""
    keys, logs_of, head = model.value
    for batch in batches:
        data, offsets = text_buffer(batch.column(2))
        for first, last in byte_slices(offsets, SLICE_BYTES):
            raw = data[offsets[first]:offsets[last]].tobytes()
            cut = (offsets[first:last + 1] - offsets[first]).tolist()
            lines, tokens, known, logs, tail, many, ends = [], [], [], [], [], [], [0]
            for a, b in zip(cut, cut[1:]):
                line, words = stream(raw[a:b])
                lines.append(line)
                n, s = 0, 0.0
                for w, c in Counter(words).items():
                    log = head.get(w)
                    if log is None:
                        tail.append(w)
                        many.append(c)
                    else:
                        n += c
                        s += c * log
                tokens.append(len(words) + 1)
                known.append(n)
                logs.append(s)
                ends.append(len(tail))
            words = pa.StructArray.from_arrays(
                [pa.array(tail, pa.binary()).cast(pa.string()), pa.array(many, pa.int64())],
                ["word", "times"])
            score, per_line, grams, times = _gram_logs(lines, keys, logs_of)
            grams = pa.StructArray.from_arrays([pa.array(grams), pa.array(times, pa.int64())], ["gram", "times"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                 pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(logs, pa.float64()),
                 pa.array(score), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per_line)], pa.int32()), grams)],
                ["doc_id", "held_out", "n_tokens", "head_known", "head_log", "head_score", "tail", "grams"])


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                min_count: int = MIN_COUNT, head_bits: int = HEAD_BITS,
                gram_head_bits: int = GRAM_HEAD_BITS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row; rows that are not held out are the training rows.

    A null or empty text is its end token alone.  Repeated rows count and are
    scored each by itself.  Without training rows no token is known, every
    byte has probability 1/256, and base_score is that of an empty vocabulary;
    an empty table gives no row.  Other columns are not read.
    """
    spark = docs.sparkSession
    d = docs.select(docs[id_col].alias("doc_id"), held_out.alias("held_out"),
                    F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    train = d.where(~F.col("held_out"))
    counts = word_counts(train)
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = train.count()
    n_all, distinct = size[0] + ends, size[1] + (ends > 0)
    common = (F.col("n") * (1 << head_bits) >= n_all) & (F.octet_length("word") <= HEAD_WORD_BYTES)
    head = {r.word.encode(): math.log10(r.n + 1) for r in counts.where(common).toLocalIterator()}
    grams = gram_scores(gram_counts(d), min_count)
    n_symbols = grams.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    often = F.col("uses") * (1 << gram_head_bits) >= n_symbols
    top = grams.where(often).select("gram", "log").toArrow()
    keys, logs = (top[c].to_numpy() for c in ("gram", "log"))
    order = np.argsort(keys)
    model = spark.sparkContext.broadcast((keys[order], logs[order], head))
    kind = d.schema["doc_id"].dataType.simpleString()
    scored = d.mapInArrow(
        lambda b: _score(model, b),
        f"doc_id {kind}, held_out boolean, n_tokens long, head_known long, head_log double, "
        "head_score double, tail array<struct<word:string,times:long>>, "
        "grams array<struct<gram:long,times:long>>")
    scored = materialize(scored.withColumn("rid", F.monotonically_increasing_id()), "scored")
    tail = scored.select("rid", F.explode("tail").alias("t")).select("rid", "t.word", "t.times")
    tail = tail.join(counts.where(~common), "word").groupBy("rid").agg(
        F.sum("times").alias("tail_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("tail_log"))
    rare = scored.select("rid", F.explode("grams").alias("g")).select("rid", "g.gram", "g.times")
    rare = rare.join(grams.where(~often), "gram").groupBy("rid").agg(
        F.sum(F.col("times") * F.col("log")).alias("rare_score"))
    divisor = math.log10(n_all + distinct + 1)
    zero = F.lit(0)
    return scored.drop("tail", "grams").join(tail, "rid", "left").join(rare, "rid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", zero) + (1 if ends else 0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.coalesce("tail_log", zero) + math.log10(ends + 1)
         - F.col("n_tokens") * divisor).alias("base_score"),
        (F.col("head_score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"))


def op3_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return score_texts(docs, held)
