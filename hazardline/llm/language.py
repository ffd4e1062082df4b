"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence multiply: the text (naive Bayes over character trigrams), the language the markup declares (how
often a declaration is right is counted), the address suffix and the host.  Host priors are smoothed
hierarchically: host towards its registered domain, that towards its suffix, that towards all pages.  All counts are
grouped sums of the pages' own posteriors, and a page's own share is taken out of its host's counts again.
"""

from __future__ import annotations

import html as htmllib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of, join_counted, stage
from hazardline.llm.textnp import LOWER, blocks, mix, utf8

BUCKETS = 1 << 15        # trigram buckets
SAMPLE = 3000            # labelled texts per language for the text model, in order of a hash of their id
STRENGTH = 20.0          # pages' worth of evidence that a level takes from the level above it
TEXT_WEIGHT = 0.2        # trigrams of running text are far from independent

DROPPED = frozenset(("script", "style", "nav", "aside", "header", "footer", "select"))
_OPEN = re.compile(r"<(?:(!--)|(\w+))")
_CLOSE = re.compile(r"</(\w+)\s*>")
_CLASS = re.compile(r"\bclass=\"(?:ad|ads|nav|menu)\"", re.I)
_TAG = re.compile(r"<[^>]*>")
_HTML = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})", re.I)
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def without_blocks(page: str) -> str:
    """A page without comments, without the elements of ``DROPPED`` and without those of an advertising or navigation class, each up to
    the next closing tag of its name; what is never closed stays.

    Time is linear in the page however broken it is: closing tags and classes are listed once, and a search that reached
    the end of the page is not begun again.
    """
    closes: dict[str, list[tuple[int, int]]] = {}
    for m in _CLOSE.finditer(page):
        closes.setdefault(m[1].lower(), []).append(m.span())
    classes = [m.span() for m in _CLASS.finditer(page)]
    out, done, at, gt, nth, comments = [], 0, 0, -1, 0, True
    while m := _OPEN.search(page, at):
        at, end = m.end(), -1
        if m[1]:
            i = page.find("-->", at) if comments else -1
            comments, end = i >= 0, i + 3 if i >= 0 else -1
        else:
            name, start = m[2].lower(), at
            drop = name in DROPPED
            if not drop and name in closes:
                while nth < len(classes) and classes[nth][0] < at:
                    nth += 1
                if nth < len(classes):
                    if gt < at:
                        gt = page.find(">", at)
                        gt = len(page) + 1 if gt < 0 else gt
                    drop, start = classes[nth][1] <= gt < len(page), gt
            if drop and name in closes:
                k = bisect_left(closes[name], (start, 0))
                end = closes[name][k][1] if k < len(closes[name]) else -1
        if end >= 0:
            out.append(page[done:m.start()])
            done = at = end
    return " ".join([*out, page[done:]])


def visible_text(page: str) -> str:
    """A page without markup, scripts, navigation and advertisements."""
    page = without_blocks(page)
    last = page.rfind(">") + 1      # beyond it no tag ends, so none is searched
    return htmllib.unescape(_TAG.sub(" ", page[:last]) + page[last:])


def declared_language(page: str) -> str:
    """The language that the first html tag with one declares; empty if there is none."""
    at = 0
    while m := _HTML.search(page, at):
        at = page.find(">", m.end())
        at = len(page) if at < 0 else at
        if found := _LANG.findall(page[m.end():at]):
            return found[-1].lower()
    return ""


def address(url: str) -> tuple[str, str, str]:
    """(host, registered domain: its last two labels, suffix: its last label); empty if there is none."""
    m = _HOST.match(url or "")
    host = m[1].lower().strip(".") if m else ""
    parts = host.split(".")
    return host, ".".join(parts[-2:]), parts[-1]


def trigrams(data: np.ndarray) -> np.ndarray:
    """Buckets of the trigrams (bytes of lower-cased text, other characters than letters as spaces)."""
    d = LOWER[data]
    d[(d < 97) | ((d > 122) & (d < 128))] = 32
    d = d[np.concatenate([[True], (d[1:] != 32) | (d[:-1] != 32)])] if len(d) else d
    if len(d) < 3:
        return np.zeros(0, np.int64)
    x = d.astype(np.uint64)
    return (mix((x[:-2] << np.uint64(16)) | (x[1:-1] << np.uint64(8)) | x[2:]) % np.uint64(BUCKETS)).astype(np.int64)


def _count(batches):
    """(lang, text) -> (lang, bucket, n), summed per batch."""
    for b in batches:
        langs = b.column("lang").to_pylist()
        data, offs = utf8(b.column("text"))
        for lang in sorted(set(langs)):
            total = np.zeros(BUCKETS, np.int64)
            for i, x in enumerate(langs):
                if x == lang:
                    total += np.bincount(trigrams(data[offs[i]:offs[i + 1]]), minlength=BUCKETS)
            k = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k, pa.int32()), pa.array(total[k])],
                                             names=["lang", "bucket", "n"])


def text_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities [languages, BUCKETS]) from at most ``sample`` labelled texts of each language.

    Every labelled language is kept: the model grows with languages times BUCKETS.
    """
    spark = docs.sparkSession
    lab = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(F.trim(F.col(lang_col))).alias("lang")) \
        .where("doc_id IS NOT NULL AND lang IS NOT NULL AND lang <> ''")
    size = {r[0]: r[1] for r in lab.groupBy("lang").count().collect()}
    langs = sorted(size)
    if not langs:
        return [], np.zeros((0, BUCKETS))
    ids = [(r[0], x) for x in langs if size[x] > sample
           for r in lab.where(F.col("lang") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()]
    ids += [tuple(r) for r in lab.where(F.col("lang").isin([x for x in langs if size[x] <= sample])).collect()]
    side = spark.createDataFrame(ids, "doc_id long, lang string").dropDuplicates()
    counts = docs_of(docs, id_col, text_col).join(F.broadcast(side), "doc_id").select("lang", "text") \
        .mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    c = np.full((len(langs), BUCKETS), 0.5)
    for r in counts.collect():      # languages * BUCKETS rows at most
        c[langs.index(r[0]), r[1]] += r[2]
    return langs, np.log(c / c.sum(1, keepdims=True))


def _evidence(langs: list[str], logp: np.ndarray):
    def run(batches):
        for b in batches:
            rows = []
            for url, page in zip(b.column("url").to_pylist(), b.column("html").to_pylist()):
                page = page or ""
                g = trigrams(np.frombuffer(visible_text(page).encode("utf-8", "replace"), np.uint8))
                like = TEXT_WEIGHT * logp[:, g].sum(1) if len(g) else np.zeros(len(langs))
                like = like - np.logaddexp.reduce(like)
                rows.append((*address(url), declared_language(page), like.tolist()))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), *[pa.array(c, pa.string()) for c in cols[:4]], pa.array(cols[4], pa.list_(pa.float64()))],
                names=["page_id", "host", "domain", "suffix", "declared", "like"])
    return run


def _softmax(logs: F.Column) -> F.Column:
    """Probabilities from an array of logs."""
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def _sums(df: DataFrame, key: str, k: int, col: str) -> DataFrame:
    """Per key the number of rows and the element-wise sum of the array ``col``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col(col)[i]) for i in range(k)]).alias("c"))


def _towards(count: F.Column, total: F.Column, above: F.Column) -> F.Column:
    return F.zip_with(count, above, lambda c, a: (c + STRENGTH * a) / (total + STRENGTH))


def page_language(pages: DataFrame, langs: list[str], logp: np.ndarray) -> DataFrame:
    """One row per page: page_id, lang, confidence, text_lang, declared.

    A page without text, declaration or address gets the most frequent language.  A declaration of another language than
    ``langs`` counts as none.  Null ids and repeated rows are answered one by one.  Without languages ``lang`` is null.
    """
    if not langs:
        return pages.select(F.col("page_id").cast("long").alias("page_id"), F.lit(None).cast("string").alias("lang"),
                            F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("text_lang"), F.lit("").alias("declared"))
    k, names = len(langs), F.array(*[F.lit(x) for x in langs])
    ev = stage(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                            F.col("html").cast("string").alias("html"))
               .mapInArrow(_evidence(langs, logp), "page_id long, host string, domain string, suffix string, declared string, like array<double>"),
               "page-evidence")
    ev = ev.withColumn("declared", F.when(F.array_contains(names, F.col("declared")), F.col("declared")).otherwise(F.lit("")))
    ev = ev.withColumn("text_post", _softmax(F.col("like")))

    # how a language's pages declare themselves: at most (languages + 1) * languages numbers
    confusion = {r[0]: r[2] for r in _sums(ev, "declared", k, "text_post").collect()}
    of = {x: [0.0] * k for x in ["", *langs]} | confusion
    per = [sum(of[d][i] for d in of) for i in range(k)]
    log_declared = {d: [float(np.log((of[d][i] + 1.0) / (per[i] + len(of)))) for i in range(k)] for d in of}
    table = ev.sparkSession.createDataFrame(list(log_declared.items()), "declared string, log_declared array<double>")
    ev = ev.join(F.broadcast(table), "declared").withColumn("both", F.zip_with("like", "log_declared", lambda a, b: a + b)).drop("log_declared")
    ev = stage(ev.withColumn("post", _softmax(F.col("both"))), "page-posteriors")

    total = ev.agg(F.count(F.lit(1)), *[F.sum(F.col("post")[i]) for i in range(k)]).first()
    everywhere = F.array(*[F.lit(((x or 0.0) + 1.0) / (total[0] + k)) for x in total[1:]])
    hosts = stage(_sums(ev, "host", k, "post").join(ev.groupBy("host").agg(F.first("domain").alias("domain"), F.first("suffix").alias("suffix")), "host"), "hosts")
    def up(key):
        return hosts.groupBy(key).agg(F.sum("n").alias("n2"), F.array(*[F.sum(F.col("c")[i]) for i in range(k)]).alias("c2"))
    suffixes = up("suffix").select("suffix", _towards(F.col("c2"), F.col("n2"), everywhere).alias("suffix_prior"))
    domains = up("domain").select("domain", F.col("n2").alias("dn"), F.col("c2").alias("dc"))
    hosts = hosts.join(suffixes, "suffix").join(domains, "domain").withColumn(
        "above", _towards(F.col("dc"), F.col("dn"), F.col("suffix_prior")))
    hosts = stage(hosts.select("host", "n", "c", "above"), "host-priors")
    out = join_counted(ev, hosts.withColumn("rows", F.col("n")), "host", ["c", "above", "n"], "rows", F.coalesce("page_id", F.lit(0)))
    prior = F.zip_with(F.zip_with("c", "post", lambda a, b: F.greatest(a - b, F.lit(0.0))), F.col("above"),
                       lambda c, a: (c + STRENGTH * a) / (F.col("n") - 1 + STRENGTH))
    out = out.withColumn("final", _softmax(F.zip_with("both", prior, lambda a, b: a + F.log(b))))
    top = F.array_max("final")
    return out.select("page_id", F.element_at(names, F.array_position("final", top).cast("int")).alias("lang"), top.alias("confidence"),
                      F.element_at(names, F.array_position("text_post", F.array_max("text_post")).cast("int")).alias("text_lang"), "declared")
