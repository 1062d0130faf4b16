"""URL filter by the ratio of two character language models.

Rules decide what they fit; the URLs they accept and reject are also the training texts of two
variable-order Markov models over bytes (A-Z count as a-z). A byte's probability after the ``TUPLE - 1`` bytes
before it is that of the longest context, smoothed with the next shorter one by Witten-Bell weights, down to 1 in
256; contexts that a class has not seen pass on to the shorter one. All other URLs are judged by the
difference of their log likelihoods per byte, against a calibrated threshold.

The threshold is cross-fitted: decided URLs fall into ``FOLDS`` folds by a hash, each is scored by models that
have not counted its fold, and the histograms of all folds together give the threshold: the middle of the range
with the best mean of the two rates of right verdicts. A URL in a third of all rows is in one fold, and counts
as often as it occurs.

The counts are a Spark table that grows with the corpus: one row for each tuple of 1 to ``TUPLE`` bytes. A context has
at most 256 continuations, so no group is larger, and a tuple meets its next shorter one in a join in which a
key has at most 256 rows. To score, the ``HEAD`` most frequent tuples (a bounded table, 2 MB) are summed up in the row; the
others, each less than 1 in ``HEAD`` of all positions, are joined, so no key is hot. Bytes of long URLs are worked on in slices of rows.

Null URLs and URLs without `://` have an empty host and path. Nothing speaks against a null or empty URL: ratio 0,
accepted. Without decided URLs of both classes the threshold is 0; without any, everything else is accepted. Repeated rows and
page_ids that are null or repeat are judged each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gistlet.llm.common import bound_batches, row_slices, text_bytes, written

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))

TUPLE = 6            # bytes of the longest counted tuple: five of context and one more
FOLDS = 2
HEAD = 100_000       # tuples whose ratios are sent to every task
BINS, REACH = 4000, 10.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SMALL = np.arange(256)
_SMALL[65:91] += 32


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first `://`, A-Z lower-cased) and path of a URL; empty where there is none."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null; of equally long ones a block."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] == "allow"))
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in order]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def tuples(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The TUPLE bytes that end at each byte, as a number (zeros before a row's start), and each byte's row."""
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    small = _SMALL[data]
    place = np.arange(len(data)) - offs[row]
    code = small.copy()
    for back in range(1, TUPLE):
        code[back:] += np.where(place[back:] >= back, small[:-back] << (8 * back), 0)
    return code, row


def _cells() -> list[tuple[int, int]]:
    """(class, fold) by slot; class 1 is accepted."""
    return [(c, f) for c in range(2) for f in range(FOLDS)]


def _models() -> list[tuple[int, int]]:
    """(class, model): model 0 has counted all folds, model 1 + f all but f."""
    return [(c, m) for c in range(2) for m in range(FOLDS + 1)]


def counted(rows: DataFrame) -> DataFrame:
    """(level, code, n, n<class>_<fold>...) for every tuple of 1 to TUPLE bytes in ``rows`` (url, slot): how often it
    occurs in all URLs, and in the decided ones of each class and fold (slot -1: undecided)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_bytes(batch.column(0))
            slot = batch.column(1).to_numpy()
            for i, j in row_slices(offs):
                code, row = tuples(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                at, n = np.unique((slot[i:j][row].astype(np.int64) + 1 << 8 * TUPLE) + code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((at >> 8 * TUPLE) - 1), pa.array(at & (1 << 8 * TUPLE) - 1), pa.array(n)],
                                                 names=["slot", "code", "n"])

    names = [f"n{c}_{f}" for c, f in _cells()]
    found = rows.select("url", "slot").mapInArrow(run, "slot long, code long, n long")
    whole = found.groupBy("code").agg(F.sum("n").alias("n"), *[
        F.sum(F.when(F.col("slot") == i, F.col("n")).otherwise(0)).alias(name) for i, name in enumerate(names)])
    whole = written(whole, "url-tuples")
    ends = F.array(*[F.struct(F.lit(k).alias("level"), F.col("code").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("code"))
                     for k in range(1, TUPLE + 1)])
    each = whole.select(F.explode(ends).alias("e"), "n", *names)
    return each.groupBy("e.level", "e.code").agg(*[F.sum(x).alias(x) for x in ("n", *names)])


def ratios(counts: DataFrame) -> DataFrame:
    """(code, n, r0, r1...) of every tuple of TUPLE bytes: the log ratio of its last byte's probabilities by each model."""
    context = Window.partitionBy("level", F.shiftright("code", 8))
    known = counts.select("level", "code", "n", *[
        (reduce(lambda a, b: a + b, [F.col(f"n{c}_{f}") for f in range(FOLDS) if f != m - 1], F.lit(0))).alias(f"c{c}_{m}")
        for c, m in _models()])
    own, lower = [], []
    for c, m in _models():
        x = F.col(f"c{c}_{m}")
        total, kinds = F.sum(x).over(context), F.sum(F.when(x > 0, 1).otherwise(0)).over(context)
        own.append(F.when(total > 0, x / (total + kinds)).otherwise(0.0).alias(f"o{c}_{m}"))
        lower.append(F.when(total > 0, kinds / (total + kinds)).otherwise(1.0).alias(f"l{c}_{m}"))
    stats = written(known.select("level", "code", "n", *own, *lower), "url-contexts")
    p = None
    for k in range(1, TUPLE + 1):
        here = stats.where(F.col("level") == k)
        if p is None:
            before = {cm: F.lit(1 / 256) for cm in _models()}
        else:
            here = here.join(p, F.col("code").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)) == F.col("shorter"))
            before = {(c, m): F.col(f"p{c}_{m}") for c, m in _models()}
        p = here.select("code", "n", *[(F.col(f"o{c}_{m}") + F.col(f"l{c}_{m}") * before[c, m]).alias(f"q{c}_{m}") for c, m in _models()])
        p = p.select(F.col("code").alias("shorter"), F.col("n").alias("times"), *[F.col(f"q{c}_{m}").alias(f"p{c}_{m}") for c, m in _models()])
    return p.select(F.col("shorter").alias("code"), F.col("times").alias("n"),
                    *[(F.log(f"p1_{m}") - F.log(f"p0_{m}")).alias(f"r{m}") for m in range(FOLDS + 1)])


def with_ratio(rows: DataFrame, table: DataFrame, head: int = HEAD) -> DataFrame:
    """``rows`` (row, url, slot, ...) with ``ratio``: the mean log ratio of a URL's bytes, by the models that have not
    counted its fold; 0 for null and empty URLs."""
    values = [f"r{m}" for m in range(FOLDS + 1)]
    top = table.orderBy(F.desc("n"), "code").limit(head).toPandas().sort_values("code")      # at most ``head`` rows
    shared = rows.sparkSession.sparkContext.broadcast((top["code"].to_numpy(np.int64), top[values].to_numpy(np.float64)))
    entry = pa.struct([("code", pa.int64()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ratio = shared.value
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            number, slot = batch.column(0), batch.column(2).to_numpy().astype(np.int64)
            for i, j in row_slices(offs):
                code, row = tuples(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                model = np.where(slot[i:j] < 0, 0, slot[i:j] % FOLDS + 1)
                at = np.searchsorted(codes, code)
                hit = np.zeros(len(code), bool)
                inside = at < len(codes)
                hit[inside] = codes[at[inside]] == code[inside]
                total = np.bincount(row[hit], ratio[at[hit], model[row[hit]]], j - i)
                far, owner = code[~hit], row[~hit]
                order = np.lexsort((far, owner))
                far, owner = far[order], owner[order]
                first = np.flatnonzero(np.append(True, (far[1:] != far[:-1]) | (owner[1:] != owner[:-1]))[:len(far)])
                times = np.diff(np.append(first, len(far)))
                entries = pa.StructArray.from_arrays([pa.array(far[first]), pa.array(times)], fields=list(entry))
                rest = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[first], np.arange(j - i + 1)), pa.int32()), entries)
                yield pa.RecordBatch.from_arrays([number.slice(i, j - i), pa.array(model), pa.array(total.astype(np.float64)), pa.array(np.diff(offs[i:j + 1]), pa.int64()), rest],
                                                 names=["row", "model", "s", "size", "rest"])

    near = written(rows.select("row", "url", "slot").mapInArrow(
        run, "row long, model long, s double, size long, rest array<struct<code: long, c: long>>"), "url-sums")
    far = near.where(F.size("rest") > 0).select("row", "model", F.explode("rest").alias("e")).select("row", "model", "e.code", "e.c")
    value = F.element_at(F.array(*values), (F.col("model") + 1).cast("int"))
    sums = far.join(table, "code").groupBy("row").agg(F.sum(F.col("c") * value).alias("more"))
    ratio = near.join(sums, "row", "left").select("row", ((F.col("s") + F.coalesce("more", F.lit(0.0)))
                                                          / F.greatest("size", F.lit(1))).alias("ratio"))
    return rows.join(ratio, "row")


def calibrate(ok: np.ndarray, bad: np.ndarray) -> float:
    """Threshold from histograms of the two classes over (-REACH, REACH)."""
    if not ok.sum() or not bad.sum():
        return 0.0
    right = (ok[::-1].cumsum()[::-1] / ok.sum() + np.append(0, bad.cumsum())[:-1] / bad.sum())
    best = np.flatnonzero(right >= right.max() - 1e-12)
    run = best[:np.flatnonzero(np.append(np.diff(best) != 1, True))[0] + 1]
    return (run[0] + run[-1]) / 2 / BINS * 2 * REACH - REACH


def judge(pages: DataFrame, rules: tuple = RULES, id_col: str = "page_id", url_col: str = "url", head: int = HEAD) -> DataFrame:
    """page_id, host, path, rule, verdict, ratio of every row; a decided URL's ratio is that of models that have not
    counted its fold."""
    bound_batches(pages.sparkSession)
    url = F.col(url_col).cast("string")
    host, path = host_path(url)
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("r", ruled(F.col("host"), F.col("path"), rules))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "url"), F.lit(FOLDS)).cast("int")
    slot = F.when(F.col("r.verdict") == "allow", fold + FOLDS).when(F.col("r").isNotNull(), fold).otherwise(-1)
    rows = written(rows.withColumn("slot", slot).withColumn("row", F.monotonically_increasing_id()), "urls")
    table = written(ratios(counted(rows)), "url-ratios")
    scored = written(with_ratio(rows, table, head), "url-scores")
    bin_ = F.floor((F.col("ratio") + REACH) / (2 * REACH) * BINS)
    hist = (scored.where("slot >= 0").groupBy((F.col("slot") >= FOLDS).alias("ok"), F.least(F.greatest(bin_, F.lit(0)), F.lit(BINS - 1)).alias("bin"))
            .count().toPandas())
    share = np.zeros((2, BINS))
    share[hist["ok"].astype(int).to_numpy(), hist["bin"].astype(int).to_numpy()] = hist["count"].to_numpy()
    empty = F.coalesce(F.col("url") == "", F.lit(True))
    by_model = F.when(empty | (F.col("ratio") >= calibrate(share[1], share[0])), "allow").otherwise("block")
    return scored.select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                         F.coalesce(F.col("r.verdict"), by_model).alias("verdict"), "ratio")
