"""Fuzzy line deduplication: MinHash over character shingles, banding, exact Jaccard, union-find; DataFrame functions only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.work import SPACE, Scratch, components, fresh, has_words, let, mark

#: Characters of a shingle, and the similarity at which lines are joined, in hundredths.
LENGTH = 5
PERCENT = 80
#: The range of hashes is cut into BINS; the smallest and the largest ENDS hashes of a bin are a band each.
BINS = 6
ENDS = 6
_CUTS = [-(1 << 63) + k * (1 << 64) // BINS for k in range(1, BINS)]
#: Of the 2 * BINS extreme hashes of the ranges so many must agree before two lines are read: at similarity 0.8 fewer do in 6 of 10,000 pairs.
AGREE = 5
#: Bands with more lines than this are compared in pairs of blocks of about this size.
BLOCK = 512
LOOK = ["n", "low", "high"]
#: The parity sketch of a line has so many words of 64 bits; a word takes the hashes of its share of their range.
WORDS = 16
SKETCH = [f"w{k}" for k in range(WORDS)]
_SHARES = [-(1 << 63) + k * (1 << 64) // WORDS for k in range(1, WORDS)]


def lines_of(docs: DataFrame, *keep: str) -> DataFrame:
    """keep, line_no (from 1), h (stands for the line), line: the lines that have a word, in lower case."""
    rows = docs.select(*keep, F.posexplode(F.split(F.lower("text"), "\n")).alias("at", "line")).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(*keep, (F.col("at") + 1).cast("bigint").alias("line_no"), F.xxhash64("line").alias("h"), "line")


def spaced(line: Column) -> Column:
    """The words of a line with single spaces."""
    odd = line.contains("  ") | line.startswith(" ") | line.endswith(" ") | line.rlike(r"[\x09-\x0D]")
    return F.when(odd, F.trim(F.regexp_replace(line, SPACE + "+", " "))).otherwise(line)


def shingles(line: Column) -> Column:
    """Hashes of the shingles of a line, LENGTH characters at every position (a shorter line is one), some perhaps repeated."""

    def hashed(code: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.octet_length(code) - (4 * LENGTH - 1), F.lit(1)), F.lit(4))
        return F.transform(at, lambda i: F.xxhash64(F.substring(code, i, F.lit(4 * LENGTH))))

    # four bytes a character, so that a position is found without reading what is before it; let() keeps them from being copied for each
    return let(F.encode(line, "UTF-32"), hashed)


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, h, n, low, high, bands: one row a line that has a word.

    n is the number of distinct shingles. Their hashes fall into BINS ranges; a range's ENDS smallest and ENDS largest are a band
    each, those of a smaller one all together; NULL where there is none. low and high hold a byte of the smallest and of the largest
    hash of each range (one-permutation MinHash).
    """
    hashes = F.sort_array(F.array_distinct(F.concat(shingles(spaced(F.col("line"))), F.array(*map(F.lit, _CUTS)))))
    rows = lines_of(docs, "doc_id").select("doc_id", "line_no", "h", hashes.alias("s"))
    # places from 1 of the cuts; the hashes of range k lie between p{k} and p{k + 1}
    rows = rows.select("*", F.lit(0).alias("p0"), *[F.array_position("s", F.lit(c)).cast("int").alias(f"p{k}") for k, c in enumerate(_CUTS, 1)], (F.size("s") + 1).alias(f"p{BINS}"))
    bands, low, high = [], F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    for k in range(BINS):
        lo, hi = F.col(f"p{k}"), F.col(f"p{k + 1}")
        m = hi - lo - 1
        byte = lambda at: F.shiftleft(F.when(m > 0, F.get("s", at).bitwiseAND(F.lit(255))).otherwise(F.lit(0).cast("bigint")), 8 * k)  # noqa: B023, E731
        bands.append(F.when(m > 0, F.xxhash64(F.lit(k), F.lit(0), F.slice("s", lo + 1, F.least(m, F.lit(ENDS))))))
        bands.append(F.when(m > ENDS, F.xxhash64(F.lit(k), F.lit(1), F.slice("s", hi - ENDS, ENDS))))
        low, high = low.bitwiseOR(byte(lo)), high.bitwiseOR(byte(hi - 2))
    # let() keeps this out of whole-stage code, which would be one method too long for the compiler
    n = let(F.size("s") - len(_CUTS), lambda x: x.cast("bigint"))
    return rows.select("doc_id", "line_no", "h", n.alias("n"), low.alias("low"), high.alias("high"), F.array(*bands).alias("bands"))


def _likely(a: str, b: str) -> Column:
    """Whether the lines whose n, low and high end in a and b can be alike by their sizes and are by the extremes of their hashes."""
    n, m = F.col(f"n{a}"), F.col(f"n{b}")
    agree = F.lit(0)
    for c in ("low", "high"):
        x = F.col(f"{c}{a}").bitwiseXOR(F.col(f"{c}{b}"))
        for k in range(BINS):
            agree = agree + (F.shiftright(x, 8 * k).bitwiseAND(F.lit(255)) == 0).cast("int")
    return (100 * n >= PERCENT * m) & (100 * m >= PERCENT * n) & (agree >= AGREE)


def _sketched(texts: DataFrame) -> DataFrame:
    """h and the words of the line's parity sketch (odd sketch): each distinct shingle turns over the bit that its hash names."""
    hashes = F.sort_array(F.array_distinct(F.concat(shingles(F.col("line")), F.array(*map(F.lit, _SHARES)))))
    rows = texts.select("h", hashes.alias("s"))
    # places from 1 of the shares' first values; the hashes of word k lie between p{k} and p{k + 1}
    rows = rows.select("*", F.lit(0).alias("p0"), *[F.array_position("s", F.lit(c)).cast("int").alias(f"p{k}") for k, c in enumerate(_SHARES, 1)], (F.size("s") + 1).alias(f"p{WORDS}"))
    part = lambda k: F.slice("s", F.col(f"p{k}") + 1, F.col(f"p{k + 1}") - F.col(f"p{k}") - 1)
    turn = lambda word, x: word.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), x.bitwiseAND(F.lit(63)).cast("int")))
    return rows.select("h", *[F.aggregate(part(k), F.lit(0).cast("bigint"), turn).alias(w) for k, w in enumerate(SKETCH)])


def _near(a: str, b: str) -> Column:
    """Whether the sketches of lines allow a similarity of PERCENT; never False where the lines have it.

    The bits in which two sketches differ are at most as many as the shingles that only one of the lines has. In lines of
    thousands of shingles bits are turned over so often that this tells less.
    """
    apart = F.lit(0)
    for w in SKETCH:
        apart = apart + F.bit_count(F.col(f"{w}{a}").bitwiseXOR(F.col(f"{w}{b}")))
    return (100 + PERCENT) * apart <= (100 - PERCENT) * (F.col(f"n{a}") + F.col(f"n{b}"))


def _texts(docs: DataFrame, wanted: DataFrame, distinct: DataFrame, work: Scratch, name: str) -> DataFrame:
    """h, line: the words of the wanted lines, read again in the documents where they first stand. Only wanted lines are shuffled."""
    wanted = work.save(wanted, f"{name}-wanted")
    firsts = work.save(distinct.join(wanted, "h").select("doc_id").distinct(), f"{name}-firsts")
    near = mark(work, docs.select("doc_id", "text"), "doc_id", firsts, f"{name}-marks").where("_maybe").select("text")
    lines = mark(work, lines_of(near).select("h", "line"), "h", wanted, f"{name}-h-marks").where("_maybe").select("h", spaced(F.col("line")).alias("line"))
    texts = work.save(lines.join(wanted, "h", "left_semi").dropDuplicates(["h"]), f"{name}-texts")
    work.drop(f"{name}-wanted", f"{name}-firsts")
    return texts


def similar(a: Column, b: Column, na: Column, nb: Column) -> Column:
    """Whether lines of na and nb distinct shingles have a Jaccard similarity of PERCENT or more over all of them."""
    return (100 + PERCENT) * F.size(F.array_intersect(shingles(a), shingles(b))) >= PERCENT * (na + nb)


def _verified(pairs: DataFrame, texts: DataFrame, work: Scratch, name: str) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose lines are alike by the full sets of their shingles, as (a, b). texts holds their lines."""
    half = pairs.join(texts.select(F.col("h").alias("a"), F.col("line").alias("la")), "a")
    both = half.join(texts.select(F.col("h").alias("b"), F.col("line").alias("lb")), "b")
    edges = work.save(both.where(similar(F.col("la"), F.col("lb"), F.col("n_a"), F.col("n_b"))).select("a", "b"), f"{name}-edges")
    return edges


def _across(docs: DataFrame, distinct: DataFrame, met: DataFrame, looks: DataFrame, joined: DataFrame, work: Scratch) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, n_a, n_b) of the lines of a band that are not joined yet and likely alike, all of them, and the lines (h, line).

    In bands of three lines or less the smallest and the largest have met all others. In the rest, those outside the band's
    largest component are set against all that are not of their own; large bands are dealt out in pairs of blocks. A pair comes
    from the first of the bands that it shares, and only if the sketches of its lines allow the similarity.
    """
    at = met.select("band", "h").join(joined.select(F.col("v").alias("h"), "c"), "h", "left").select("band", "h", F.coalesce("c", "h").alias("c"))
    at = work.save(at, "at")
    parts = at.groupBy("band", "c").agg(F.count("*").alias("k"))
    open_ = parts.groupBy("band").agg(F.count("*").alias("parts"), F.sum("k").alias("m"), F.max(F.struct("k", "c")).alias("most")).where("parts > 1 and m > 3")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    open_ = work.save(open_.select("band", F.col("most.c").alias("big"), blocks(F.col("m") - F.col("most.k")).alias("rows"), blocks(F.col("m")).alias("cols")), "open")
    at = work.save(at.join(open_, "band"), "open-at")
    lines = work.save(at.groupBy("h").agg(F.collect_set("band").alias("bands")), "open-lines")
    texts = _texts(docs, lines.select("h"), distinct, work, "open")
    at = at.join(work.save(lines.join(looks, "h").join(_sketched(texts), "h"), "open-looks"), "h")
    own = lambda n: F.pmod(F.xxhash64("h"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    side = lambda df, end: df.select("band", "i", "j", F.col("h").alias(end), F.col("c").alias(f"c_{end}"), *[F.col(x).alias(f"{x}_{end}") for x in ("bands", *LOOK, *SKETCH)])
    rest = side(at.where("c != big").withColumn("i", own("rows")).withColumn("j", every("cols")), "a")
    all_ = side(at.withColumn("j", own("cols")).withColumn("i", every("rows")), "b").join(open_.select("band", "big"), "band")
    # two lines outside the largest component meet twice
    new = (F.col("c_a") != F.col("c_b")) & ((F.col("c_b") == F.col("big")) | (F.col("a") < F.col("b"))) & _likely("_a", "_b") & _near("_a", "_b")
    # lines of two components are met in every open band that they share
    new = new & (F.col("band") == F.array_min(F.array_intersect("bands_a", "bands_b")))
    small = F.col("a") < F.col("b")
    pairs = rest.join(all_, ["band", "i", "j"]).where(new)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(small, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"), F.when(small, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b")), texts


def duplicate_lines(docs: DataFrame, work: Scratch) -> DataFrame:
    """doc_id, removed (line numbers): the lines of which a like line comes earlier, by (doc_id, line number).

    Lines are alike if a chain of lines of Jaccard similarity 0.8 or more over their shingles joins them. Equal lines are
    one line with its first place. The shingle hashes of a line fall into BINS ranges; the ENDS smallest and the ENDS largest
    of each are a band (two bottom-k MinHash sketches a range), those of a smaller bin all together. Lines that share a band
    are set against its smallest and its largest line first, if the extreme hashes of the ranges make that likely (see AGREE);
    all pairs of the band that this has not joined follow. Links are verified on the full sets.
    """
    lines = work.save(_signed(docs), "lines")
    distinct = work.save(lines.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("times")), "distinct")
    banded = lines.select("h", *LOOK, F.explode("bands").alias("band")).where("band is not null")
    ends = work.save(banded.groupBy("band").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a != b"), "ends")
    met = mark(work, banded, "band", ends, "ends-marks").where("_maybe").drop("_maybe").dropDuplicates(["band", "h"]).join(ends, "band")
    met = work.save(met, "met")
    looks = work.save(met.select("h", *LOOK).dropDuplicates(["h"]), "looks")
    first = met.select("h", F.explode(F.array("a", "b")).alias("g")).where("h != g").select(F.least("h", "g").alias("a"), F.greatest("h", "g").alias("b")).distinct()
    of = lambda end: looks.select(F.col("h").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in LOOK])
    pairs = work.save(first.join(of("a"), "a").join(of("b"), "b").where(_likely("_a", "_b")).select("a", "b", "n_a", "n_b"), "pairs")
    texts = _texts(docs, pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct(), distinct, work, "ends")
    edges = _verified(pairs, texts, work, "ends")
    work.drop("ends-texts")
    rest, texts = _across(docs, distinct, met, looks, components(work, edges, "ends"), work)
    rest = work.save(rest.join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    more = _verified(rest, texts, work, "rest")
    work.drop("met", "looks", "at", "open", "open-at", "open-lines", "open-looks", "open-texts", "ends", "pairs", "rest")
    joined = components(work, edges.union(more), "lines")
    named = distinct.select("h", "times").join(joined.select(F.col("v").alias("h"), "c"), "h", "left").where("c is not null or times > 1").select("h", F.coalesce("c", "h").alias("c"))
    cand = work.save(lines.select("doc_id", "line_no", "h").join(named, "h").select("doc_id", "line_no", "c"), "candidates")
    docs0 = work.save(cand.groupBy("c").agg(F.min("doc_id").alias("doc0")), "first-docs")
    firsts = work.save(cand.join(docs0, "c").where("doc_id = doc0").groupBy("c", "doc0").agg(F.min("line_no").alias("line0")), "firsts")
    gone = cand.join(firsts, "c").where("doc_id != doc0 or line_no != line0")
    return work.save(gone.groupBy("doc_id").agg(F.collect_set("line_no").alias("removed")), "removed")


def dedup_lines(docs: DataFrame, drop_emptied: bool = True) -> DataFrame:
    """docs without the lines of which a like line comes earlier; n_chars, where there is one, is counted anew.

    Lines without words stay, as do texts without them and NULL texts. A document that had lines with words and keeps none is
    a copy and goes, unless drop_emptied is False. Rows with a NULL doc_id stay as they are and make no other line go. Rows
    that share a doc_id count as one document: their lines at the same place are one. Columns beside doc_id and text stay.
    """
    work = Scratch(docs.sparkSession, "lines")
    removed = duplicate_lines(docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text"), work)
    flag, of, gone = fresh(docs, "_maybe"), fresh(docs, "_of"), fresh(docs, "_removed")
    marked = mark(work, docs, "doc_id", removed, "removed-marks", flag)
    # a merge join at every size: what is removed grows with the documents
    of_docs = removed.select(F.col("doc_id").alias(of), F.col("removed").alias(gone)).hint("merge")
    rows = marked.where(F.col(flag)).join(of_docs, F.col("doc_id") == F.col(of), "left")

    def kept(ls: Column) -> Column:
        return F.array_join(F.transform(F.array_except(F.sequence(F.lit(1), F.size(ls)), F.col(gone)), lambda i: F.get(ls, i - 1)), "\n")

    same = F.col(gone).isNull()
    out = rows.withColumn("text", F.when(same, F.col("text")).otherwise(let(F.split("text", "\n"), kept)))
    if drop_emptied:
        out = out.where(same | has_words(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    mine = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(*mine).unionByName(marked.where(~F.col(flag)).select(*mine))


# The same shingles in numpy, without Spark: the tests hold the operator's columns against them.

#: Bits of a key that tell the line, and characters that are treated at one time (a longer line goes alone).
PLACE, CHARS = 14, 1 << 20
_FACTORS = np.random.default_rng(7).integers(1 << 62, 1 << 63, LENGTH + 1, dtype=np.uint64) | np.uint64(1)
_HASH = np.uint64(64 - PLACE)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingle_keys(lines: list[bytes]) -> np.ndarray:
    """The distinct shingles of each line as rising keys: the line's place in its first PLACE bits, the shingle's hash in the others.

    A shingle is LENGTH characters, one at every position; a shorter line is one shingle. Lines have no line ends and are
    fewer than 2 ** PLACE.
    """
    code = np.frombuffer(b"\n".join([*lines, b""]).decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    end = np.flatnonzero(code == 10)
    start = np.concatenate([[0], end[:-1] + 1])
    size = end - start
    code = np.concatenate([code, np.zeros(LENGTH, np.uint64)])
    h = code[: -LENGTH] * _FACTORS[0]
    for k in range(1, LENGTH):
        h += code[k : len(h) + k] * _FACTORS[k]
    for i in np.flatnonzero(size < LENGTH).tolist():
        h[start[i]] = np.append(code[start[i] : end[i]] * _FACTORS[: size[i]], _FACTORS[-1:] * np.uint64(size[i])).sum()
    many = np.maximum(size - (LENGTH - 1), 1)
    line = np.repeat(np.arange(len(lines)), many)
    at = np.arange(len(line)) + np.repeat(start - (np.cumsum(many) - many), many)
    keys = line.astype(np.uint64) << _HASH | _mixed(h[at]) >> np.uint64(PLACE)
    keys.sort()
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])]


def alike(first: list[bytes], second: list[bytes]) -> np.ndarray:
    """Which pairs of lines have a Jaccard similarity of PERCENT or more over all their shingles."""
    out = np.zeros(len(first), bool)
    lo = 0
    while lo < len(first):
        hi, chars = lo, 0
        while hi < len(first) and hi - lo < (1 << PLACE) - 1 and (hi == lo or chars + len(first[hi]) + len(second[hi]) <= CHARS):
            chars += len(first[hi]) + len(second[hi])
            hi += 1
        a, b = shingle_keys(first[lo:hi]), shingle_keys(second[lo:hi])
        count = lambda keys: np.bincount((keys >> _HASH).astype(np.int64), minlength=hi - lo)  # noqa: B023, E731
        all_ = np.concatenate([a, b])
        all_.sort()
        both = count(all_[1:][all_[1:] == all_[:-1]])
        out[lo:hi] = 100 * both >= PERCENT * (count(a) + count(b) - both)
        lo = hi
    return out


def _sets(lines: list[bytes]) -> list[np.ndarray]:
    """Each line's shingles as rising hashes."""
    out, lo = [], 0
    while lo < len(lines):
        hi, chars = lo + 1, len(lines[lo])
        while hi < len(lines) and hi - lo < (1 << PLACE) - 1 and chars + len(lines[hi]) <= CHARS:
            chars += len(lines[hi])
            hi += 1
        keys = shingle_keys(lines[lo:hi])
        ends = np.searchsorted(keys, np.arange(1, hi - lo, dtype=np.uint64) << _HASH)
        out += np.split(keys & np.uint64((1 << (64 - PLACE)) - 1), ends)
        lo = hi
    return out
