"""Operator 7: line dedup by an exact set-similarity join, DataFrame functions only.

A line's tokens are its shingles of five words (lower case, split at spaces;
a line with fewer words is one shingle), a line is the set of its tokens.
Two lines match when the Jaccard similarity of their sets is at least 0.8; a
line goes when a matching line stands earlier, by (doc_id, hash of the text,
copy of the row, line number).  Every line that holds a word takes part.

1. ``line_places``: each line's key (the hash of its words) and place, narrow rows
   that are written once; the first place of each key.  Later copies of a
   line go without being compared, only first copies are made into sets.
2. ``lines_left``: a line of n tokens can only match when at most
   n - ceil(0.8 n) of its tokens stand in no other line.  The tokens that
   their own hash picks are looked up in all lines, and lines that hold more
   tokens of their own than that go on no further, in exact steps: neither
   they nor others lose a match.  Short lines mostly go on.
3. The tokens of the lines left are written once and counted in ``2^COUNT_BITS`` hash buckets, and the buckets are
   ranked by count: one array of fixed size.  A token's code is its bucket's
   rank followed by the other bits of its hash, so codes sort rare tokens
   first and lose no bit.
4. Two sets of n and m tokens can only match when they share a token of their
   first n - ceil(0.8 n) + 1 codes (prefix filter), when 0.8 n <= m (length
   filter), and when the tokens behind the shared one still allow the needed
   overlap (positional filter).  The prefixes are dealt by token, and those
   that no other line has are dropped there.
5. For each token, lines are first compared with the token's earliest line:
   who matches it can't find an earlier one there.  Only the others are
   joined with the earlier lines of their token.  That join has the length
   among its keys (its number of binary digits, which differs by one at most
   between lines that match), and the shorter line of a pair must hold the
   token within its first n / 9 codes: behind them its overlap with no line
   of at least its length can suffice.  So lines of a template that differ
   in a word meet in no pair, however many they are.
6. Candidates are verified on the whole sets of tokens written.
7. The numbers of the lines that go come back by (doc_id, hash of the text).

Nulls and empties: a null or empty text and lines without a word stay as they
are; null doc_ids sort first; rows with the same doc_id and other texts are
documents of their own; of rows equal in both the first copy is compared and
the others lose every line that holds a word; an empty table gives an empty
result; all columns of the input are kept and only the text changes (and
``count_as``, if named, which replaces a column of that name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from nightshift.llm.common import copies_apart, cut
from nightshift.operators.joins import bounded_broadcast

SHINGLE = 5
#: Jaccard threshold as an exact fraction.
NUMER, DENOM = 4, 5
COUNT_BITS = 14
#: So many of 16 tokens, by hash, are looked for in other lines first: more than the fifth in which lines that match can differ.
TAKEN, TAKEN_OF = 5, 16


def _once(column: Column) -> Column:
    """A generator of the one value: what stands behind it is not made anew at every use."""
    return F.explode(F.array(column))


def _lines(docs: DataFrame) -> DataFrame:
    """``(d, t, line, key, s)``: the lines that hold a word, as their words in lower case with single spaces."""
    lines = docs.select(
        F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"), F.posexplode(F.split(F.lower("text"), "\n")).alias("line", "raw")
    )
    words = F.trim("raw")
    even = F.when(F.instr("raw", "  ") > 0, F.regexp_replace(words, " +", " ")).otherwise(words)
    even_lines = lines.select("d", "t", "line", _once(even).alias("s")).where("s <> ''")
    return even_lines.select("d", "t", "line", _once(F.xxhash64("s")).alias("key"), "s")


def _words(lines: DataFrame, *columns: str) -> DataFrame:
    return lines.select(*columns, _once(F.split("s", " ")).alias("w"))


def line_places(docs: DataFrame) -> DataFrame:
    """``(key, d, t, line, words)`` of every line that holds a word; ``words``: how many."""
    # Words stand apart by one space each.
    words = F.octet_length("s") - F.octet_length(F.replace("s", F.lit(" "), F.lit(""))) + 1
    return cut(_lines(docs).select("key", "d", "t", "line", words.alias("words")), "line-places")


def first_places(places: DataFrame) -> DataFrame:
    """``(key, first, n, words)``: first place and count of the lines of the same words, and the number of these."""
    place = F.struct("d", "t", "line")
    return cut(places.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.max("words").alias("words")), "line-firsts")


def _first_copies(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """``(key, s)``: each line at its first place alone; lines that occur once need no look at the others."""
    repeated = bounded_broadcast(cut(firsts.where("n > 1").select(F.col("key").alias("__key"), "first"), "line-repeats"))
    lines = _lines(docs).join(repeated, F.col("key") == F.col("__key"), "left")
    here = F.col("first.d").eqNullSafe(F.col("d")) & (F.col("first.t") == F.col("t")) & (F.col("first.line") == F.col("line"))
    return lines.where(F.col("__key").isNull() | here).select("key", "s")


def lines_left(copies: DataFrame, firsts: DataFrame) -> DataFrame:
    """``(key, first)`` of the lines that can match another, with their first place.

    A token is taken by its hash alone, so all lines that hold it take it, and one
    that a single line takes stands in no other.  A line of n places has n tokens at most.
    """
    n = F.greatest(F.size("w") - (SHINGLE - 1), F.lit(1))
    shingles = F.arrays_zip(*[F.slice("w", k + 1, n).alias(f"w{k}") for k in range(SHINGLE)])
    rows = _words(copies, "key").select("key", F.inline(shingles))
    tokens = rows.select("key", F.xxhash64(*[f"w{k}" for k in range(SHINGLE)]).alias("token"))
    taken = tokens.where(F.col("token").bitwiseAND(TAKEN_OF - 1) < TAKEN)
    # Counted before they are dealt, so a frequent token is one row of a task.
    seen = taken.groupBy("token").agg(F.min("key").alias("key"), F.max("key").alias("b"))
    own = seen.where("key = b").groupBy("key").agg(F.count(F.lit(1)).alias("own"))
    places = F.greatest(F.col("words") - (SHINGLE - 1), F.lit(1))
    left = firsts.join(own, "key", "left").where(F.col("own").isNull() | (DENOM * F.col("own") <= (DENOM - NUMER) * places))
    return cut(left.select("key", "first"), "line-left")


def line_tokens(copies: DataFrame) -> DataFrame:
    """``(key, tokens)``: the hashes of each line's shingles, each once."""
    def token(w: Column, i: Column) -> Column:
        return F.xxhash64(w, *[F.get("w", i + k) for k in range(1, SHINGLE)])

    n = F.greatest(F.size("w") - (SHINGLE - 1), F.lit(1))
    tokens = _words(copies, "key").select("key", _once(F.transform(F.slice("w", F.lit(1), n), token)).alias("tokens"))
    return tokens.select("key", F.array_distinct("tokens").alias("tokens"))


def _ranks(tokens: DataFrame) -> str:
    """For each hash bucket its rank by token count, from -2^(bits-1), comma-joined: a fixed number of ranks."""
    size = 1 << COUNT_BITS
    counts = tokens.select(F.explode("tokens").alias("t")).groupBy(F.col("t").bitwiseAND(size - 1).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    buckets = tokens.sparkSession.range(size).join(counts, "id", "left").na.fill(0, ["n"])
    # 2^COUNT_BITS rows, whatever the input.
    rank = F.row_number().over(Window.orderBy("n", "id")) - 1 - size // 2
    ranked = buckets.select("id", rank.alias("rank")).agg(F.array_sort(F.collect_list(F.struct("id", "rank"))).alias("r"))
    return ranked.select(F.array_join(F.col("r.rank").cast("array<string>"), ",")).first()[0]


def _coded(tokens: DataFrame, ranks: str) -> DataFrame:
    """``(key, codes)``: each line's set of token codes, rare ones first."""
    # Folds into one array literal at planning.
    table = F.split(F.lit(ranks), ",").cast("array<long>")
    low = (1 << COUNT_BITS) - 1

    def code(t: Column) -> Column:
        rest = F.shiftrightunsigned(t, COUNT_BITS)
        return F.shiftleft(F.get(table, t.bitwiseAND(low).cast("int")), 64 - COUNT_BITS).bitwiseOR(rest)

    return tokens.select("key", _once(F.sort_array(F.transform("tokens", code))).alias("codes"))


def bucket_ranks(copies: DataFrame) -> str:
    """``_ranks`` of the lines' tokens."""
    return _ranks(line_tokens(copies))


def line_sets(copies: DataFrame, ranks: str) -> DataFrame:
    """``_coded`` of the lines' tokens."""
    return _coded(line_tokens(copies), ranks)


def _needed(n: Column) -> Column:
    """ceil(threshold * n)."""
    return F.floor((NUMER * n + (DENOM - 1)) / DENOM).cast("int")


def shared_prefixes(sets: DataFrame, firsts: DataFrame) -> DataFrame:
    """``(token, key, place, n, at)`` for prefix tokens that several lines share; ``sets`` has a row for each key."""
    n = F.size("codes")
    prefix = F.slice("codes", 1, n - _needed(n) + 1)
    posts = sets.select("key", n.alias("n"), F.posexplode(prefix).alias("at", "token")).repartition("token")
    # Tokens are counted in fixed memory, and most are unique.  Every column is
    # read, as both sides of the join share an exchange only if it is the same.
    seen = posts.groupBy("token").agg(F.min("key").alias("a"), F.max("key").alias("b"), F.max("n").alias("n"), F.max("at").alias("at"))
    shared = seen.where("a <> b AND n > 0 AND at >= 0").select("token")
    held = posts.join(shared.hint("shuffle_hash"), "token")
    placed = held.join(firsts.select("key", F.col("first").alias("place")), "key")
    return cut(placed.select("token", "key", "place", "n", "at"), "line-prefixes")


def _possible(x: str, y: str) -> Column:
    """Length and positional filter of two prefix rows that share a token."""
    n, m, i, j = F.col(f"{x}.n"), F.col(f"{y}.n"), F.col(f"{x}.at"), F.col(f"{y}.at")
    length = (NUMER * n <= DENOM * m) & (NUMER * m <= DENOM * n)
    return length & ((NUMER + DENOM) * (1 + F.least(n - i - 1, m - j - 1)) >= NUMER * (n + m))


def _as_shorter() -> Column:
    """Whether a prefix row can be that of the shorter (or equally long) line of a pair."""
    return (NUMER + DENOM) * F.col("at") <= F.col("n")


def _digits() -> Column:
    return F.length(F.bin("n"))


def earlier_pairs(later: DataFrame, posts: DataFrame) -> DataFrame:
    """``(key, other)``: lines of ``later`` and the earlier lines of their tokens that pass the filters."""
    def by_length(rows: DataFrame, near: tuple[int, ...]) -> DataFrame:
        return rows.withColumn("digits", F.explode(F.array(*[_digits() + k for k in near])))

    found = []
    for shorter_is_later in (True, False):
        x, y = later, posts
        if shorter_is_later:
            x, y = by_length(x.where(_as_shorter()), (0, 1)), by_length(y, (0,))
            order = F.col("x.n") <= F.col("y.n")
        else:
            x, y = by_length(x, (0,)), by_length(y.where(_as_shorter()), (0, 1))
            order = F.col("x.n") > F.col("y.n")
        met = x.alias("x").join(y.alias("y"), ["token", "digits"])
        met = met.where(order & (F.col("y.place") < F.col("x.place")) & _possible("x", "y"))
        found.append(met.select(F.col("x.key").alias("key"), F.col("y.key").alias("other")))
    return found[0].unionByName(found[1]).distinct()


def _verified(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """Of ``(key, other)`` (written) the pairs whose whole sets match."""
    def held(side: str) -> DataFrame:
        # Only the sets of lines that stand on that side are dealt out.
        return whole.join(bounded_broadcast(pairs.select(F.col(side).alias("key")).distinct()), "key", "left_semi")

    x = held("key").select("key", F.col("codes").alias("cx"))
    y = held("other").select(F.col("key").alias("other"), F.col("codes").alias("cy"))
    both = F.size(F.array_intersect("cx", "cy"))
    return (
        pairs.join(x, "key").join(y, "other")
        .where((NUMER + DENOM) * both >= NUMER * (F.size("cx") + F.size("cy")))
        .select("key", "other")
    )


def earlier_matches(whole: DataFrame, posts: DataFrame) -> DataFrame:
    """``(key)`` of the lines whose first place comes after a different line that matches; ``whole``: ``(key, codes)``, the sets of all, in any order."""
    first = posts.groupBy("token").agg(F.min(F.struct("place", "key", "n", "at")).alias("e"))
    star = posts.alias("x").join(first.select("token", "e.*").alias("y"), "token").where(F.col("y.place") < F.col("x.place"))
    possible = star.where(_possible("x", "y")).select(F.col("x.key").alias("key"), F.col("y.key").alias("other"))
    star_pairs = cut(possible.distinct(), "line-star")

    found = cut(_verified(star_pairs, whole), "line-found")
    # A line that matched some token's earliest line goes; only the others look further.
    rest = posts.join(found.select("key").distinct(), "key", "left_anti")
    later = cut(earlier_pairs(cut(rest, "line-rest"), posts).join(star_pairs, ["key", "other"], "left_anti"), "line-later")
    return found.select("key").unionByName(_verified(later, whole).select("key")).distinct()


def lines_that_go(docs: DataFrame) -> DataFrame:
    """``(d, t, gone)``: the sorted numbers of the lines that go, by doc_id and hash of the text."""
    places = line_places(docs)
    firsts = first_places(places)
    copies = _first_copies(docs, firsts)
    left = lines_left(copies, firsts)
    tokens = cut(line_tokens(copies.join(bounded_broadcast(left.select("key")), "key", "left_semi")), "line-sets")
    posts = shared_prefixes(_coded(tokens, _ranks(tokens)), left)
    matched = earlier_matches(tokens.withColumnRenamed("tokens", "codes"), posts)
    # One row per line that occurs twice or matches an earlier one.
    going = left.join(bounded_broadcast(cut(matched, "line-matched")), "key").select("key", F.col("first").alias("place"), F.lit(True).alias("all"))
    repeats = firsts.where("n > 1").select("key", "first")
    marked = repeats.join(going, "key", "full").select("key", F.coalesce("first", "place").alias("first"), F.coalesce("all", F.lit(False)).alias("all"))
    held = bounded_broadcast(cut(marked, "line-marked"))
    going = places.join(held, "key").where(F.col("all") | (F.struct("d", "t", "line") > F.col("first")))
    lists = going.groupBy("d", "t").agg(F.sort_array(F.collect_set("line")).alias("gone"))
    return cut(lists, "line-gone")


def _without(lines: Column, gone: Column) -> Column:
    """What is left of an array without the places of ``gone`` (sorted): the runs between them."""
    before = F.concat(F.array(F.lit(-1)), gone)
    after = F.concat(gone, F.array(F.size(lines)))
    return F.flatten(F.zip_with(before, after, lambda a, b: F.slice(lines, a + 2, b - a - 1)))


def dedup_lines(docs: DataFrame, count_as: str | None = None) -> DataFrame:
    """``docs`` without the lines that match an earlier one; ``count_as`` names a column for the number of lines that went."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    gone = bounded_broadcast(lines_that_go(texts)).alias("own")
    apart = copies_apart(docs).alias("doc")
    text = F.col("doc.text").cast("string")
    joined = apart.join(gone, F.col("doc.doc_id").eqNullSafe(F.col("own.d")) & (F.xxhash64(text) == F.col("own.t")), "left")
    parted = F.when(F.col("doc.__again") | F.col("own.gone").isNotNull(), F.split(text, "\n"))
    rows = joined.select(*[F.col(f"doc.`{c}`") for c in docs.columns], "doc.__again", F.col("own.gone").alias("__gone"), _once(parted).alias("__lines"))
    again, known, lines = F.col("__again"), F.col("__gone").isNotNull(), F.col("__lines")
    left = F.when(again, F.filter(lines, lambda s: F.trim(s) == "")).when(known, _without(lines, F.col("__gone")))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.when(lines.isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias(c))
        elif c != count_as:
            out.append(F.col(f"`{c}`"))
    if count_as:
        words = F.size(F.filter(lines, lambda s: F.trim(s) != ""))
        went = F.when(lines.isNull(), 0).when(again, words).otherwise(F.size("__gone"))
        out.append(went.cast("long").alias(count_as))
    return rows.select(*out)
