"""Phrases of two to four words whose parts go together, counted in tiles of ranked ids.

Three passes over the texts. The first counts words. The most frequent words of all languages are ranked, and in the second
pass each task counts neighbouring pairs: a pair of ranked words is a cell of a square tile of ranks, counted with a dense
bincount where a tile is well filled and by sorting its cells where it is sparse; pairs with an unranked word are
sorted as coordinates. Pairs frequent enough then become units that are ranked in turn, and the third pass
counts a pair with the word behind it (three words) and with the pair behind it (four) in the same way. The ranked units and a
bitmap of all frequent ones have a fixed size, and are all that is sent to the tasks; what the bitmap lets through wrongly
is counted and dropped later. Units outside the ranks are known by 64-bit names of their language and words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import _LOWER, Texts, mix, prefix_hashes, release, small_batches, span_hashes, text_chunks
from holdfast.session import staged

TOP = 2000  # phrases reported per language


@dataclass(frozen=True)
class Settings:
    """Limits of the counting; only `least` and `contained` say what a phrase is."""

    least: int = 30  # occurrences of a candidate
    contained: int = 80  # percent of a phrase's occurrences from which a longer one replaces it
    scale: int = 2_000_000
    ranked: int = 65_536  # units that get a rank
    tile: int = 256  # ranks along a tile's side
    dense: int = 512  # pairs in a tile from which it is counted densely
    held: int = 500_000  # pairs gathered in a task before they are counted
    bits: int = 1 << 26  # of the bitmap of frequent units
    spread: int = 64  # parts a language's candidates are ranked in first
    chunk: int = 500_000  # bytes of text handled at a time


DEFAULT = Settings()

# A pair of ranked units is shuffled as one small number and its kind is raised by RANKS.
RANKS = 10
RANK_LIMIT = 1 << 20

_U = np.uint64
_TURN = _U(0x9E3779B97F4A7C15)

_bytes = np.arange(256)
BREAK = np.isin(_bytes, [ord(c) for c in ".,;:!?\n\v\f\r"])
WORD = ~(BREAK | np.isin(_bytes, [32, 9]))


@dataclass
class Units:
    """Units known to the tasks: the ranked names, and a bitmap of the names of all frequent units."""

    names: np.ndarray  # ascending
    ranks: np.ndarray
    by_rank: np.ndarray
    bitmap: np.ndarray

    def rank(self, names: np.ndarray) -> np.ndarray:
        """The rank of each name, -1 for none."""
        if not len(self.names):
            return np.full(len(names), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where(self.names[at] == names, self.ranks[at], -1)

    def frequent(self, names: np.ndarray) -> np.ndarray:
        slot = (names & _U(64 * len(self.bitmap) - 1)).astype(np.int64)
        return (self.bitmap[slot >> 6] >> (slot & 63).astype(np.uint64)) & _U(1) == 1


def pair_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The name of two units one behind the other."""
    return mix(left * _TURN + mix(right + _TURN))


def language_name(lang: str) -> np.uint64:
    return _U(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


@dataclass
class Spoken:
    """Words of a chunk with their places, names and pieces; words of a text are neighbours in it."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    names: np.ndarray
    pieces: np.ndarray
    text: np.ndarray


def spoken(texts: Texts, languages: list[str]) -> Spoken:
    """The lower-cased words of the texts, which stand in one piece when no delimiter is between them."""
    data = _LOWER[texts.data]
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = WORD[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text = np.searchsorted(texts.first, starts, side="right") - 1
    tags = np.array([language_name(lang) for lang in languages], dtype=np.uint64)
    names = mix(span_hashes(prefix_hashes(data), starts, ends) + tags[text])
    return Spoken(data, starts, ends, names, np.searchsorted(np.flatnonzero(BREAK[data]), starts), text)


def _chunks(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[tuple[Spoken, list[str]]]:
    """Batches of (lang, text)."""
    for batch in batches:
        for texts in text_chunks(batch.column(1), settings.chunk):
            languages = [v or "" for v in batch.column(0).slice(texts.rows.start, len(texts)).to_pylist()]
            yield spoken(texts, languages), languages


def _words(settings: Settings):
    """Tasks that return (lang, word, f) of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for said, languages in _chunks(batches, settings):
            _, first, counts = np.unique(said.names, return_index=True, return_counts=True)
            data = said.data.tobytes()
            text = [data[a:b].decode() for a, b in zip(said.starts[first].tolist(), said.ends[first].tolist())]
            own = [languages[t] for t in said.text[first].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array(text, pa.string()), pa.array(counts)], names=["lang", "word", "f"])

    return run


def _named_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to (lang, word, f) the names that texts give the words."""
    for batch in batches:
        tags = np.array([language_name(lang) for lang in batch.column(0).to_pylist()], dtype=np.uint64)
        names = [np.zeros(0, np.uint64)]
        for words in text_chunks(batch.column(1)):
            names.append(mix(span_hashes(prefix_hashes(words.data), words.first[:-1], words.first[1:] - 1) + tags[words.rows]))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(names).view(np.int64))], names=["lang", "word", "f", "name"])


class Tally:
    """Counts pairs of units, as many as `held` at a time."""

    def __init__(self, kind: int, left: Units, right: Units, settings: Settings) -> None:
        self.kind, self.left, self.right, self.settings = kind, left, right, settings
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
        most = self.settings.held
        for at in range(0, len(left), most):
            self.parts.append((left[at : at + most], right[at : at + most]))
            self.held += len(self.parts[-1][0])
            if self.held >= most:
                yield self.counted()

    def counted(self) -> pa.RecordBatch:
        """The pairs gathered, with their counts; forgets them."""
        left, right = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (zip(*self.parts) if self.parts else ([], [])))
        self.parts, self.held = [], 0
        a, b = self.left.rank(left), self.right.rank(right)
        ranked = (a >= 0) & (b >= 0)
        i, j, n = tiled(a[ranked], b[ranked], self.settings)
        far_left, far_right, far_n = coordinates(left[~ranked], right[~ranked])
        kind = np.repeat([self.kind + RANKS, self.kind], [len(n), len(far_n)])
        left, right = np.concatenate([i * RANK_LIMIT + j, far_left.view(np.int64)]), np.concatenate([np.zeros(len(n), np.int64), far_right.view(np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(left), pa.array(right), pa.array(np.concatenate([n, far_n]))], names=["kind", "left", "right", "n"])


def tiled(a: np.ndarray, b: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of ranks with their counts, tile by tile."""
    width, side = settings.tile, settings.ranked // settings.tile + 1
    tile = (a // width) * side + b // width
    order = np.argsort(tile.astype(np.int32), kind="stable")
    tile, a, b = tile[order], a[order], b[order]
    heads = np.flatnonzero(np.diff(tile, prepend=-1))
    sizes = np.diff(np.append(heads, len(tile)))
    cells = (a % width) * width + b % width
    rows, cols, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    dense = sizes >= settings.dense
    for head, size in zip(heads[dense].tolist(), sizes[dense].tolist()):
        n = np.bincount(cells[head : head + size], minlength=width * width)
        filled = np.flatnonzero(n)
        rows.append(tile[head] // side * width + filled // width)
        cols.append(tile[head] % side * width + filled % width)
        counts.append(n[filled])
    sparse = ~np.repeat(dense, sizes)
    keys, n = np.unique(tile[sparse] * width * width + cells[sparse], return_counts=True)
    tile, cells = keys // (width * width), keys % (width * width)
    rows.append(tile // side * width + cells // width)
    cols.append(tile % side * width + cells % width)
    counts.append(n)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(counts)


def coordinates(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of names with their counts, by sorting."""
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    fresh = np.ones(len(left), dtype=bool)
    fresh[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    heads = np.flatnonzero(fresh)
    return left[heads], right[heads], np.diff(np.append(heads, len(left)))


def _pairs(words: Units, settings: Settings):
    """Tasks that count neighbouring frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(2, words, words, settings)
        for said, _ in _chunks(batches, settings):
            known = words.frequent(said.names)
            at = np.flatnonzero(known[:-1] & known[1:] & (said.pieces[:-1] == said.pieces[1:]) & (said.text[:-1] == said.text[1:]))
            yield from tally.add(said.names[at], said.names[at + 1])
        yield tally.counted()

    return run


def _longer(words: Units, pairs: Units, settings: Settings):
    """Tasks that count frequent pairs with the word and with the pair behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        three, four = Tally(3, pairs, words, settings), Tally(4, pairs, pairs, settings)
        for said, _ in _chunks(batches, settings):
            if len(said.names) < 3:
                continue
            two = pair_names(said.names[:-1], said.names[1:])
            known = pairs.frequent(two) & (said.pieces[:-1] == said.pieces[1:]) & (said.text[:-1] == said.text[1:])
            triple = known[:-1] & known[1:]
            at = np.flatnonzero(triple)
            yield from three.add(two[at], said.names[at + 2])
            at = np.flatnonzero(triple[:-1] & triple[1:])
            yield from four.add(two[at], two[at + 2])
        yield three.counted()
        yield four.counted()

    return run


def _named(sides: dict[int, tuple[Units, Units]]):
    """Tasks that turn counted pairs into (kind, a_name, b_name, n, name), name being the pair's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, left, right = (batch.column(i).to_numpy() for i in range(3))
            a, b = left.view(np.uint64).copy(), right.view(np.uint64).copy()
            for k, (one, two) in sides.items():
                own = kind == k + RANKS
                a[own], b[own] = one.by_rank[left[own] // RANK_LIMIT], two.by_rank[left[own] % RANK_LIMIT]
            kind = np.where(kind > RANKS, kind - RANKS, kind)
            columns = [pa.array(kind, pa.int32()), *(pa.array(x.view(np.int64)) for x in (a, b)), batch.column(3), pa.array(pair_names(a, b).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "a_name", "b_name", "n", "name"])

    return run


def units(frequent: DataFrame, by: str, settings: Settings) -> Units:
    """What tasks need of the frequent units (name, and a count `by`): `ranked` rows and `bits` bits at most."""
    top = frequent.orderBy(F.desc(by), "name").select("name").limit(settings.ranked).toArrow().column(0).to_numpy().view(np.uint64)
    order = np.argsort(top)
    slot = F.expr(f"name & {settings.bits - 1}L")
    slots = frequent.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(name & 63 AS int)))").alias("bits"))
    bitmap = np.zeros(settings.bits // 64, dtype=np.uint64)
    for batch in slots.toArrow().to_batches():
        bitmap[batch.column(0).to_numpy()] = batch.column(1).to_numpy().view(np.uint64)
    return Units(top[order], order, top, bitmap)


def phrase_counts(docs: DataFrame, settings: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): every word of each language with its count, and (lang, phrase, words, f) of the phrases of two to
    four words with `least` occurrences or more."""
    spark = docs.sparkSession
    small_batches(spark)
    said = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    counted = said.mapInArrow(_words(settings), "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))
    words = staged(counted.mapInArrow(_named_words, "lang string, word string, f long, name long"), "words")
    release(spark)
    frequent = words.where(f"f >= {settings.least}")
    known = spark.sparkContext.broadcast(units(frequent, "f", settings))
    total = lambda df: df.groupBy("kind", "left", "right").agg(F.sum("n").alias("n")).where(f"n >= {settings.least}")
    found, named = "kind int, left long, right long, n long", "kind int, a_name long, b_name long, n long, name long"
    twos = total(said.mapInArrow(lambda b: _pairs(known.value, settings)(b), found))
    twos = staged(twos.mapInArrow(lambda b: _named({2: (known.value, known.value)})(b), named), "pairs")
    release(spark)
    pairs = spark.sparkContext.broadcast(units(twos, "n", settings))
    more = total(said.mapInArrow(lambda b: _longer(known.value, pairs.value, settings)(b), found))
    more = staged(more.mapInArrow(lambda b: _named({3: (pairs.value, known.value), 4: (pairs.value, pairs.value)})(b), named), "longer")
    release(spark)

    w = frequent.select(F.col("name").alias("name"), "lang", "word")
    left = w.select(F.col("name").alias("a_name"), "lang", F.col("word").alias("a"))
    right = w.select(F.col("name").alias("b_name"), F.col("word").alias("b"))
    two = twos.join(left, "a_name").join(right, "b_name").select("name", "lang", F.concat_ws(" ", "a", "b").alias("phrase"), "n")
    two = staged(two, "pair_texts")
    head = two.select(F.col("name").alias("a_name"), "lang", F.col("phrase").alias("a"))
    tail = two.select(F.col("name").alias("b_name"), F.col("phrase").alias("b"))
    three = more.where("kind = 3").drop("name").join(head, "a_name").join(right, "b_name")
    four = more.where("kind = 4").drop("name").join(head, "a_name").join(tail, "b_name")
    longer = lambda df, k: df.select("lang", F.concat_ws(" ", "a", "b").alias("phrase"), F.lit(k).alias("words"), F.col("n").alias("f"))
    found = two.select("lang", "phrase", F.lit(2).alias("words"), F.col("n").alias("f")).unionByName(longer(three, 3)).unionByName(longer(four, 4))
    return words, staged(found, "phrases")


def collocations(docs: DataFrame, top: int = TOP, settings: Settings = DEFAULT) -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z, null is empty, a null language `und`. Delimiters part a text into pieces, blanks and tabs
    a piece into words; a phrase stands within a piece. Every row counts, repeated ones too. Ties of the cut
    go to the shorter first part, ties of the score to the larger count and then the smaller phrase.
    Tables without a phrase of `least` occurrences give no rows.
    """
    words, phrases = phrase_counts(docs, settings)
    parts = words.where(f"f >= {settings.least}").select("lang", F.col("word").alias("phrase"), "f").unionByName(phrases.where("words < 4").select("lang", "phrase", "f"))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    cut = phrases.selectExpr("lang", "phrase", "f AS a", "split(phrase, ' ', -1) AS w").selectExpr("*", "explode(sequence(1, size(w) - 1)) AS k")
    cut = cut.selectExpr("lang", "phrase", "a", "k", "array_join(slice(w, 1, k), ' ') AS head", "array_join(slice(w, k + 1, size(w) - k), ' ') AS tail")
    scored = cut.join(parts.selectExpr("lang", "phrase AS head", "f AS l"), ["lang", "head"]).join(parts.selectExpr("lang", "phrase AS tail", "f AS r"), ["lang", "tail"])
    whole = "CAST({} AS decimal(20,0))"
    score = f"CAST({settings.scale} * {whole.format('a')} AS decimal(38,0)) div ({whole.format('l')} + {whole.format('r')})"
    best = scored.selectExpr("lang", "phrase", "a", f"struct({score} AS score, k, l, r) AS cut").groupBy("lang", "phrase").agg(F.min("cut").alias("cut"), F.first("a").alias("a"))
    inner = phrases.where("words > 2").selectExpr("lang", "f", "split(phrase, ' ', -1) AS w").selectExpr(
        "lang", "f", "explode(filter(flatten(transform(sequence(1, size(w) - 1), i -> transform(sequence(2, size(w)), "
        "m -> CASE WHEN m < size(w) AND i + m - 1 <= size(w) THEN array_join(slice(w, i, m), ' ') END))), p -> p IS NOT NULL)) AS phrase"
    )
    covered = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(covered, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * {whole.format('longer')} < {settings.contained} * {whole.format('a')}")
    kept = kept.selectExpr("lang", "phrase", "a", "cut.l AS l", "cut.r AS r", "cut.score AS score")
    # each language is ranked in `spread` parts first, which bounds what the last ranking holds
    order = "ORDER BY score DESC, a DESC, phrase"
    near = kept.selectExpr("*", f"row_number() OVER (PARTITION BY lang, pmod(xxhash64(phrase), {settings.spread}) {order}) AS near").where(f"near <= {top}")
    ranked = near.selectExpr("*", f"CAST(row_number() OVER (PARTITION BY lang {order}) AS bigint) AS rank").where(f"rank <= {top}")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle() -> str:
    """The registered query as DuckDB SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    grams = " UNION ALL ".join(
        f"SELECT lang, {' || '.join(['w1', *[f''' ' ' || w{i}''' for i in range(2, m + 1)]])} AS phrase, {m} AS words FROM behind WHERE w{m} IS NOT NULL" for m in (1, 2, 3, 4)
    )
    behind = ", ".join(f"lead(w, {i - 1}) OVER (PARTITION BY doc, piece ORDER BY pos) AS w{i}" for i in (2, 3, 4))
    return f"""
      WITH texts AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text FROM documents),
      pieces AS (SELECT doc, lang, p, generate_subscripts(p, 1) AS piece FROM (SELECT doc, lang, string_split_regex(text, '[.,;:!?\\n\\x0B\\f\\r]') AS p FROM texts)),
      spoken AS (SELECT doc, lang, piece, regexp_extract_all(p[piece], '[^ \\t]+') AS w FROM pieces),
      words AS (SELECT doc, lang, piece, unnest(w) AS w, generate_subscripts(w, 1) AS pos FROM spoken),
      behind AS (SELECT lang, w AS w1, {behind} FROM words),
      grams AS ({grams}),
      f AS (SELECT lang, phrase, words, count(*) AS f FROM grams GROUP BY ALL),
      total AS (SELECT lang, sum(f) AS n FROM f WHERE words = 1 GROUP BY lang),
      c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= {DEFAULT.least}),
      cuts AS (SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail FROM c, generate_series(1, 3) g(k) WHERE k < words),
      best AS (
        SELECT lang, phrase, any_value(a) AS a, min(struct_pack(score := score, k := k, l := l, r := r)) AS cut FROM (
          SELECT cuts.*, x.f AS l, y.f AS r, (CAST({DEFAULT.scale} AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) + y.f) AS score
          FROM cuts JOIN f x ON struct_pack(l := x.lang, p := x.phrase) = struct_pack(l := cuts.lang, p := head)
            JOIN f y ON struct_pack(l := y.lang, p := y.phrase) = struct_pack(l := cuts.lang, p := tail))
        GROUP BY lang, phrase),
      covered AS (
        SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS longer FROM c, generate_series(1, 3) g(i), generate_series(2, 3) h(m)
        WHERE m < words AND i + m - 1 <= words GROUP BY ALL),
      kept AS (
        SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY cut.score DESC, a DESC, encode(b.phrase)) AS rank
        FROM best b LEFT JOIN covered v ON b.lang = v.lang AND b.phrase = v.phrase WHERE longer IS NULL OR 100 * longer < {DEFAULT.contained} * a)
      SELECT kept.lang, rank, phrase, a, CAST(cut.l AS BIGINT) AS l, CAST(cut.r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(cut.score AS BIGINT) AS score
      FROM kept JOIN total ON kept.lang = total.lang WHERE rank <= {TOP}"""
