"""Repetition inside single texts: the repeated share, and the divergence from what is usual in the language."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A word is a longest run of letters or digits; case is ignored.
WORD = re.compile(r"[^\W_]+")
#: Words of a run.
RUN = 5
#: Characters that are worked on at a time inside a batch.
CHUNK_CHARS = 4_000_000
#: Common words of a language that form its reference histogram.
COMMON = 200
#: Texts with fewer words have no divergence: their histograms say too little.
MIN_WORDS = 50
#: Character classes: lower case, upper case, digit, white space, other.
CLASSES = 5

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _spread(x: np.ndarray) -> np.ndarray:
    """Mixes the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_words(lists: list[list[str]], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Number of words, and of those that lie in a run which also begins at an earlier word, of each text."""
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    total = int(sizes.sum())
    if total == 0:
        return sizes, np.zeros(len(lists), dtype=np.int64)
    codes = pd.factorize(np.array([w for x in lists for w in x], dtype=object))[0].astype(np.uint64)
    doc = np.repeat(np.arange(len(lists)), sizes)
    m = total - run + 1
    covered = np.zeros(total + 1, dtype=np.int64)
    if m > 0:
        with np.errstate(over="ignore"):
            key = np.zeros(m, dtype=np.uint64)
            for k in range(run):
                key = _spread(key + (codes[k : k + m] + np.uint64(1)) * _MIX[k])
            key = _spread(key + (doc[:m].astype(np.uint64) + np.uint64(1)) * _MIX[5])
        inside = np.flatnonzero(doc[:m] == doc[run - 1 :])
        order = inside[np.argsort(key[inside], kind="stable")]
        again = order[1:][key[order[1:]] == key[order[:-1]]]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + run, -1)
    hit = (np.cumsum(covered)[:total] > 0).astype(np.int64)
    ends = np.cumsum(sizes)
    sums = np.concatenate([[0], np.cumsum(hit)])
    return sizes, sums[ends] - sums[ends - sizes]


def char_classes(text: str | None) -> np.ndarray:
    """Counts of the character classes of a text."""
    if not text:
        return np.zeros(CLASSES)
    low = sum(map(str.islower, text))
    up, dig, sp = sum(map(str.isupper, text)), sum(map(str.isdigit, text)), sum(map(str.isspace, text))
    return np.array([low, up, dig, sp, len(text) - low - up - dig - sp], dtype=float)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2) of two histograms; NaN if one is empty."""
    if p.sum() <= 0 or q.sum() <= 0:
        return float("nan")
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    kl = lambda a: float(np.sum(a[a > 0] * np.log2(a[a > 0] / m[a > 0])))
    return float(np.sqrt(max(0.0, (kl(p) + kl(q)) / 2)))


def plain_lang(lang: str = "lang"):
    """The language as two lower-case letters, or '?' where it isn't known."""
    return F.coalesce(F.nullif(F.regexp_extract(F.lower(F.trim(F.col(lang))), r"^([a-z]{2})(?:[-_].*)?$", 1), F.lit("")), F.lit("?"))


def _chunks(ids: list, texts: list) -> Iterator[tuple[list, list]]:
    size, a = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK_CHARS:
            yield ids[a : i + 1], texts[a : i + 1]
            size, a = 0, i + 1
    if a < len(texts):
        yield ids[a:], texts[a:]


def repeated_share(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_repeated, repeated_share) of every text, whole.

    A word is repeated if it lies in a run of five words that also begins at an earlier word of the same text,
    case ignored. Null and empty texts, and those under six words, have a share of 0. Repeated rows
    give repeated results; further columns are ignored; texts may be of any length.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for ids, texts in _chunks(pdf["id"].tolist(), pdf["text"].tolist()):
                n, rep = repeated_words([words_of(t) for t in texts])
                yield pd.DataFrame({"id": ids, "n_words": n, "n_repeated": rep, "repeated_share": rep / np.maximum(n, 1)})

    return d.mapInPandas(run, f"id {d.schema['id'].dataType.simpleString()}, n_words bigint, n_repeated bigint, repeated_share double")


def references(docs: DataFrame, lang: str = "lang", text: str = "text", common: int = COMMON) -> DataFrame:
    """Per language: counts of its most common words and of the character classes, over all texts.

    Rows (lang, kind, item, n) with kind 'word' or 'class'; at most ``common`` + 5 rows a language. Words are
    ranked in buckets first, so that a language that holds most texts makes no large task.
    """
    d = docs.select(plain_lang(lang).alias("lang"), F.lower(F.col(text)).alias("low"), F.col(text).alias("text"))
    w = d.select("lang", F.explode(F.regexp_extract_all("low", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("item"))
    w = w.groupBy("lang", "item").agg(F.count(F.lit(1)).alias("n")).withColumn("b", F.pmod(F.hash("item"), F.lit(64)))
    top = lambda df, *by: df.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "item"))).where(F.col("r") <= common)
    words = top(top(w, "lang", "b"), "lang").select("lang", F.lit("word").alias("kind"), "item", "n")
    pats = [r"\p{Ll}", r"\p{Lu}", r"\p{Nd}", r"[\s\p{Z}]"]
    cl = d.groupBy("lang").agg(F.sum(F.length("text")).alias("all"), *[F.sum(F.regexp_count("text", F.lit(p))).alias(f"c{i}") for i, p in enumerate(pats)])
    cl = cl.withColumn("c4", F.col("all") - F.col("c0") - F.col("c1") - F.col("c2") - F.col("c3"))
    classes = cl.select("lang", F.lit("class").alias("kind"), F.explode(F.map_from_arrays(F.array(*[F.lit(str(i)) for i in range(CLASSES)]), F.array(*[F.coalesce(f"c{i}", F.lit(0)) for i in range(CLASSES)]))).alias("item", "n"))
    return words.unionByName(classes)


def divergence(docs: DataFrame, refs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, n_words, js_classes, js_words): Jensen-Shannon distance of a text from the reference of its language.

    The word histogram has the common words of the language and one class for all others. Texts under
    ``min_words`` words have null in both. The references are bounded by the number of languages
    (two letters each) times their size, and are sent to all tasks.
    """
    ref: dict[str, tuple[dict[str, int], np.ndarray, np.ndarray]] = {}
    rows = refs.collect()
    for g in {r["lang"] for r in rows}:
        words = sorted((r["item"], r["n"]) for r in rows if r["lang"] == g and r["kind"] == "word")
        cls = np.array([float(n) for _, n in sorted((int(r["item"]), r["n"]) for r in rows if r["lang"] == g and r["kind"] == "class")])
        ref[g] = ({w: i for i, (w, _) in enumerate(words)}, np.array([float(n) for _, n in words] + [0.0]), cls)
    d = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), plain_lang(lang).alias("lang"))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for i, t, g in zip(pdf["id"], pdf["text"], pdf["lang"]):
                w = words_of(t)
                if len(w) < min_words or g not in ref:
                    out.append((i, len(w), None, None))
                    continue
                index, common, classes = ref[g]
                h = np.zeros(len(common))
                for x in w:
                    h[index.get(x, -1)] += 1
                h[-1] = 0  # rare words are as different in any two texts
                out.append((i, len(w), js_distance(char_classes(t), classes), js_distance(h, common)))
            yield pd.DataFrame(out, columns=["id", "n_words", "js_classes", "js_words"])

    return d.mapInPandas(run, f"id {d.schema['id'].dataType.simpleString()}, n_words bigint, js_classes double, js_words double")
