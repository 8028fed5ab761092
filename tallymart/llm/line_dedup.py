"""Line deduplication by a segment-partition edit join, with DataFrame functions only.

A line goes if an equal line, or one within `edits` insertions, deletions and substitutions of bytes,
stands before it in the corpus (by document identifier, then position). Two lines within that distance
share a segment: of the shorter one's edits + 1 even segments at least one is untouched in the longer one, at
a place bounded by the edits left on either side. So

1. lines are reduced to distinct ones (combined before the shuffle: a line that is everywhere is one row),
2. each is indexed by its segments, keyed by segment number, line length and bytes,
3. each probes, for every length it could be compared with, the few substrings that can equal a segment,
4. keys shared by more than two lines are dealt out again with a part of each line's bigram parities (two lines within the
   distance agree in at least one of the parts), so that they meet only where they are alike elsewhere too, and
   pair only if lengths and all parities allow it. Under a key of many lines (a template's) what is left of a line without
   the shared segment loses the ends that all of them have in common and is cut into segments once more, as lines
   within the distance are so in the rest too. Rests of a few bytes meet by what stays of them when bytes are taken out or
   masked, so that of a numbered template's lines those meet that are within the distance, and no others, and
5. candidates lose the bytes they begin and end with in common (which leaves the distance as it is) and are verified by a banded
   bit-parallel edit distance: the 2 * edits + 1 diagonals around the main one are the bits of two numbers, and a byte of the
   text is one round of shifts and logic.

What is kept of the verified pairs is a row for each line with its number of links. Verdicts go back to the occurrences of a line
by run (the lines of one input partition), so a line that is everywhere is one row a run.

Lines shorter than `least` bytes are never removed and remove nothing.

Defined cases: a null text has no lines and stays null; an empty text is one empty line. Rows with a null or
repeated identifier are documents of their own: among one identifier's rows the row number decides which is first.
A null identifier comes first. Line ends are `\\n` only; a text's
line may hold any other character. An empty table gives an empty result. Extra columns pass through
`deduplicated` and are ignored by the rest.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallymart.llm.common import release, scratch, unused, written

#: Lines (two 64-bit keys and a place each) that may be broadcast; beyond it the join shuffles.
BROADCAST_LINES = 400_000
#: Lines that meet under one key, if all index it (else the root of those that do times all); where there are more, they meet by what the key leaves of them.
CROWD = 64
#: Bytes of a rest that is not cut into segments any more.
SHORT = 8
#: Rests that a task takes at most, twelve substrings each, and their bytes.
RESTS_A_TASK, BYTES_A_TASK = 10_000, 8 << 20
LINE = ["h1", "h2"]
REST = ["key", "id", "b", "less", "indexed"]


def as_bytes(line: Column) -> Column:
    """A string with a character for each UTF-8 byte, so that lengths and edits count bytes."""
    return F.decode(F.encode(line, "UTF-8"), "ISO-8859-1")


def keyed(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """docs with a column that tells rows of one identifier apart, and its name.

    It is 0 where the identifier is the row's own. Rows with a null or repeated identifier are numbered and written, so that
    their numbers stay what they are.
    """
    name, row, key = F.col(id_col).cast("long"), unused("_row", docs), unused("_id", docs)
    ids = docs.groupBy(name.alias(key)).agg(F.count("*").alias("n")).filter(F.col(key).isNull() | (F.col("n") > 1)).select(key)
    ids = written(ids, "line-repeated-ids")
    n = ids.count()
    if not n:
        return docs.withColumn(row, F.lit(0).cast("long")), row
    side = F.broadcast(ids) if n <= BROADCAST_LINES else ids
    shared = written(docs.join(side, name.eqNullSafe(F.col(key)), "left_semi").withColumn(row, F.monotonically_increasing_id()), "line-shared-ids")
    return docs.join(side, name.eqNullSafe(F.col(key)), "left_anti").withColumn(row, F.lit(0).cast("long")).unionByName(shared), row


def lines_of(docs: DataFrame, row: str, least: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row, pos, line, h1, h2 of the lines that take part."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(row).alias("row"), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line"))
    return rows.filter(F.octet_length("line") >= least).select("doc_id", "row", "pos", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), F.col("line")).alias("h2"))


def segment_start(length: Column, i: Column, edits: int) -> Column:
    """1-based start of segment i (from 1): the last length % (edits + 1) segments are one byte longer."""
    over = F.pmod(length, F.lit(edits + 1))
    return (1 + (length - over) / (edits + 1) * (i - 1) + F.greatest(F.lit(0), i - 1 - (edits + 1) + over)).cast("int")


def places(less: int, edits: int) -> list[Column]:
    """less, i, shift: the substrings of a line that can equal segment i of a line `less` bytes shorter."""
    return [
        F.struct(F.lit(less).alias("less"), F.lit(i).alias("i"), F.lit(shift).alias("shift"))
        for i in range(1, edits + 2)
        for shift in range(max(1 - i, less - (edits + 1 - i)), min(i - 1, less + (edits + 1 - i)) + 1)
    ]


def segment_rows(lines: DataFrame, edits: int) -> DataFrame:
    """key, indexed, less, id, b, at, size: the segments of each line (indexed), and every other substring of it that can equal a segment of a line as long or up to `edits` shorter.

    lines: id, bytes b and their number n. Under a key all lines that index it are equally long, the others `less` bytes longer.

    The places are rows of a literal array rather than as many expressions, so that the generated code
    stays small enough to be compiled.
    """
    rows = lines.select("id", "b", "n", F.explode(F.array(*[p for less in range(edits + 1) for p in places(less, edits)])).alias("p"))
    rows = substrings(rows.select("id", "b", "n", "p.*"), edits)
    return rows.withColumn("indexed", (F.col("less") == 0) & (F.col("shift") == 0)).select("key", "indexed", "less", "id", "b", "at", "size")


def rest_rows(rests: DataFrame, edits: int) -> DataFrame:
    """segment_rows of rests (key, indexed, less, id, b).

    Of two lines that meet under a key one indexes it and is the shorter one, so only what indexed the key indexes again, and what is `less` bytes
    longer takes the substrings for that alone.
    """
    at = F.get(F.array(*[F.array(*places(less, edits)) for less in range(edits + 1)]), F.col("less"))
    rows = rests.select(F.col("key").alias("of"), "id", "b", F.length("b").alias("n"), "indexed", F.explode(at).alias("p"))
    rows = substrings(rows.select("of", "id", "b", "n", "indexed", "p.*"), edits, "of")
    return rows.withColumn("indexed", F.col("indexed") & (F.col("less") == 0) & (F.col("shift") == 0)).select("key", "indexed", "less", "id", "b", "at", "size")


def substrings(rows: DataFrame, edits: int, *of: str) -> DataFrame:
    """rows (id, b, n, less, i, shift) with place, size and key of their substrings. of: columns within whose values keys are made."""
    rows = rows.withColumn("length", F.col("n") - F.col("less"))
    rows = rows.withColumns({"start": segment_start(F.col("length"), F.col("i"), edits), "stop": segment_start(F.col("length"), F.col("i") + 1, edits)})
    rows = rows.withColumns({"at": F.col("start") + F.col("shift"), "size": F.col("stop") - F.col("start")}).filter((F.col("at") >= 1) & (F.col("at") + F.col("size") - 1 <= F.col("n")))
    return rows.withColumn("key", F.xxhash64(*of, "i", "length", F.substring("b", F.col("at"), F.col("size"))))


def met(rows: DataFrame) -> DataFrame:
    """key, x, y, n, ones of the keys of segment_rows under which different lines meet: smallest and largest id, rows, and rows that index it."""
    keys = rows.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.count("*").alias("n"), F.count_if("indexed").alias("ones"))
    return keys.filter("ones > 0 AND x <> y")


def rests(rows: DataFrame) -> DataFrame:
    """Rows of segment_rows with what b is without the substring."""
    rest = F.concat(F.substring("b", F.lit(1), F.col("at") - 1), F.substring("b", F.col("at") + F.col("size"), F.length("b")))
    return rows.withColumn("b", rest).drop("at", "size")


def bigram_parities(b: Column, edits: int) -> Column:
    """4 * edits + 1 numbers of 64 bits, of which lines within `edits` edits have at least one in common.

    A pair of neighbouring bytes belongs to one number and one bit of it; the bit is whether such pairs are odd in number. An edit
    changes at most four pairs.
    """
    parts = 4 * edits + 1
    pairs = F.transform(F.sequence(F.lit(1), F.length(b) - 1), lambda i: F.pmod(F.xxhash64(F.substring(b, i, F.lit(2))), F.lit(64 * parts)).cast("int"))
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(k, F.lit(64)))
    zero = F.array(*[F.lit(0).cast("long")] * parts)
    # A lambda's outside is evaluated for each element, so the state carries all that is needed.
    return F.aggregate(pairs, zero, lambda s, k: F.transform(s, lambda v, i: F.when(i == F.floor(k / 64), v.bitwiseXOR(bit(k))).otherwise(v)))


def few(keys: DataFrame) -> DataFrame:
    """A written table of keys, for a broadcast if it is small."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_LINES else keys


def release_after(keys: DataFrame) -> None:
    """release, if lines met these keys by a shuffle, with their bytes: its files are about as large as the table of all lines."""
    if keys.count() > BROADCAST_LINES:
        release(keys.sparkSession)


def crowded_rows(lines: DataFrame, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """key, id, b, less, many, indexed of the segment_rows of lines under keys (key, many); b, what the key leaves of the line, where there are many.

    Keys too many for a broadcast meet the rows by a shuffle. A line has a dozen rows, so they go without its bytes, which are then
    fetched for the lines under keys of many.
    """
    if keys.count() <= BROADCAST_LINES:
        some = rests(rows.join(F.broadcast(keys), "key")).withColumn("b", F.when(F.col("many"), F.col("b")))
    else:
        light = written(rows.drop("b").join(keys, "key"), "line-crowded-places")
        release(lines.sparkSession)
        ids = written(light.filter("many").select("id").distinct(), "line-crowded-ids")
        texts = written(lines.join(few(ids), "id", "left_semi").select("id", "b"), "line-crowded-texts")
        release_after(ids)
        some = rests(light.filter("many").join(texts, "id")).unionByName(light.filter("NOT many").drop("at", "size"), allowMissingColumns=True)
    return some.groupBy("key", "id", "b", "less", "many").agg(F.max("indexed").alias("indexed"))


def candidate_pairs(distinct: DataFrame, edits: int) -> DataFrame:
    """x < y: ids of lines with a common key that one of them indexes; written.

    A key with two rows is a pair, found by an aggregation that combines before the shuffle. The rows of keys with more
    (lines that are variants of each other share most segments) meet again in crowded_pairs, those of very many in template_pairs.
    """
    lines = distinct.select(F.col("h1").alias("id"), "b", "n")
    rows = segment_rows(lines, edits)
    keys = written(met(rows), "line-keys")
    release(lines.sparkSession)  # a row for each segment was shuffled
    some = written(crowded_rows(lines, rows, keys.filter("n > 2").select("key", (F.col("n") * F.col("ones") > CROWD * CROWD).alias("many"))), "line-crowded")
    crowd, many = some.filter("NOT many").drop("many", "b", "less"), some.filter("many").drop("many")
    ids = written(crowd.select("id").distinct(), "line-crowded-ids")
    marks = lines.join(few(ids), "id", "left_semi").select("id", "n", bigram_parities(F.col("b"), edits).alias("p"))
    marked = written(crowd.join(marks, "id"), "line-marked")
    release_after(ids)
    pairs = keys.filter("n = 2").select("x", "y").unionByName(crowded_pairs(marked, edits))
    for found in template_pairs(many, edits):
        pairs = pairs.unionByName(found)
    return written(pairs.distinct(), "line-candidates")


def crowded_pairs(marked: DataFrame, edits: int) -> DataFrame:
    """x < y of lines with a common key, of which one is indexed, and near enough in length and parities.

    marked: key, id, indexed, n, p. A pair meets under each number of p that it has in common and is taken at the first.
    """
    parts = 4 * edits + 1
    rows = marked.select("id", "indexed", "n", "p", F.posexplode("p").alias("part", "own"), "key").withColumn("key", F.xxhash64("key", "part", "own"))
    one = rows.filter("indexed").select("key", "part", F.col("id").alias("x"), F.col("n").alias("xn"), F.col("p").alias("xp"))
    other = rows.select("key", F.col("id").alias("y"), F.col("n").alias("yn"), F.col("p").alias("yp"))
    differ = [F.col("xp")[i] != F.col("yp")[i] for i in range(parts)]
    first = F.coalesce(*[F.when(~d, F.lit(i)) for i, d in enumerate(differ)])
    bits = sum((F.bit_count(F.col("xp")[i].bitwiseXOR(F.col("yp")[i])) for i in range(parts)), F.lit(0))
    near = (F.col("x") != F.col("y")) & (F.abs(F.col("xn") - F.col("yn")) <= edits) & (first == F.col("part")) & (bits <= 4 * edits)
    return one.join(other, "key").filter(near).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))


def tasks_of(rows: DataFrame) -> int:
    """Tasks for a step over rests (key, id, b) of a table, by how many they are and their bytes; none if there are none."""
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("b"))).first()
    return max(6, -(-n // RESTS_A_TASK), -(-size // BYTES_A_TASK)) if n else 0


def template_pairs(rows: DataFrame, edits: int) -> list[DataFrame]:
    """x < y of lines with a common key that one of them indexes, and near rests, in written tables.

    rows: key, id, b (what the key leaves of the line), less, indexed, from a table. Lines that are within the edits with the key's bytes untouched are so in b. A
    rest loses at least a byte a round, mostly a third of it, and what all under its key begin or end with. Rests that need no more
    rounds wait in their tables and are paired together in the end. Every step reads only what the round before has written, so
    its tasks follow from that table's size and not from the number of partitions of a shuffle of the whole corpus.
    """
    short, small, rows, most = [], [], rows.select(*REST), 0
    while tasks := tasks_of(rows):
        most += tasks
        rows = without_copies(without_ends(rows, tasks), tasks)
        # All that indexes a key is equally long and the rest no shorter, so the whole key is short or is not.
        least = F.length("b") - F.col("less")
        short.append(rows.filter(least <= SHORT))
        again = rest_rows(rows.filter(least > SHORT), edits)
        keys = written(met(again).select("key", (F.col("n") * F.col("ones") > CROWD * CROWD).alias("many")).coalesce(tasks), "line-rest-keys")
        again = written(rests(again.join(few(keys), "key")).groupBy("key", "id", "b", "less", "many").agg(F.max("indexed").alias("indexed")).coalesce(tasks), "line-rests")
        small.append(again.filter("NOT many").select(*REST))
        rows = again.filter("many").select(*REST)
    if not short:
        return []
    return [written(pairs.coalesce(most), "line-template-pairs") for pairs in (short_pairs(union_of(short), edits, most), small_pairs(union_of(small), edits, most))]


def dealt(df: DataFrame, tasks: int | None) -> DataFrame:
    """df in at most so many tasks, where their number is known: partitions of its last shuffle are taken together."""
    return df.coalesce(tasks) if tasks else df


def union_of(tables: list[DataFrame]) -> DataFrame:
    """All rows; a key of one round is another than one of the next, as it is a hash of that."""
    return reduce(DataFrame.unionByName, tables)


def without_ends(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """rows (key, b and more) with b without the bytes that all rows of a key begin and end with, which the smallest and the largest of them tell."""
    back = F.reverse("b")
    ends = rows.groupBy("key").agg(F.min("b").alias("x"), F.max("b").alias("y"), F.min(back).alias("rx"), F.max(back).alias("ry"), F.min(F.length("b")).alias("least"))
    steps = halves(1 << 30)  # more than a string can have; a step beyond its length is one comparison of numbers
    ends = ends.withColumns({"front": agreement(F.col("x"), F.col("y"), F.col("least"), steps), "back": agreement(F.col("rx"), F.col("ry"), F.col("least"), steps)})
    ends = written(dealt(ends.select("key", "front", F.least("back", F.col("least") - F.col("front")).alias("back")), tasks), "line-rest-ends")
    return rows.join(few(ends), "key").withColumn("b", F.substring("b", F.col("front") + 1, F.length("b") - F.col("front") - F.col("back"))).select(*rows.columns)


def without_copies(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """One key of those that have the same rows (a template's segments all have), of a written table."""
    rows = written(dealt(rows.distinct(), tasks), "line-rests")
    rest = [c for c in rows.columns if c != "key"]
    sums = rows.groupBy("key").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64(*rest)).alias("u"), F.bit_xor(F.xxhash64(*reversed(rest), F.lit(1))).alias("v"))
    keys = written(dealt(dealt(sums, tasks).groupBy("m", "u", "v").agg(F.min("key").alias("key")).select("key"), tasks), "line-rest-keys")
    return rows.join(few(keys), "key", "left_semi")


def paired(rows: DataFrame, keys: list[str], near: Column) -> DataFrame:
    """x < y of near rows with equal keys of which one is indexed; two that both are meet once."""
    both = rows.filter("indexed").drop("indexed").withColumnsRenamed({"id": "x"} | {c: f"x_{c}" for c in rows.columns if c not in ("id", "indexed", *keys)})
    both = both.join(rows.withColumnsRenamed({"id": "y"} | {c: f"y_{c}" for c in rows.columns if c not in ("id", *keys)}), keys)
    once = (F.col("x") < F.col("y")) | (~F.col("y_indexed") & (F.col("x") != F.col("y")))
    return both.filter(once & near).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))


def small_pairs(rows: DataFrame, edits: int, tasks: int | None = None) -> DataFrame:
    """x < y under keys of few rows (key, id, b, less, indexed) whose bigram parities allow it; their lengths do.

    Keys that have the same rows once common ends are gone count once: lines that are variants of each other share very many.
    """
    rows = without_copies(without_ends(rows, tasks), tasks)
    parities = bigram_parities(F.col("b"), edits)
    rows = written(dealt(rows.select("key", "id", "indexed", parities.alias("p")), tasks), "line-rest-marks")
    bits = sum((F.bit_count(F.col("x_p")[i].bitwiseXOR(F.col("y_p")[i])) for i in range(4 * edits + 1)), F.lit(0))
    return paired(rows, ["key"], bits <= 4 * edits)


def short_pairs(rows: DataFrame, edits: int, tasks: int | None = None) -> DataFrame:
    """x < y of rests (key, id, b, and indexed unless all are) within `edits`, and no others.

    Such rests are equal once each has lost some bytes and some bytes at equal places are masked; as many edits as bytes lost in either
    and masked lead from one to the other. The mask is a character that no byte is.
    """
    mask = "\u0100"
    indexed = F.col("indexed") if "indexed" in rows.columns else F.lit(True).alias("indexed")
    forms = rows.select("key", "id", indexed, "b", F.lit(0).alias("masked"), F.lit(0).alias("lost"))
    found = forms
    for _ in range(edits):
        at = forms.filter(F.length("b") > 0).select("*", F.explode(F.sequence(F.lit(1), F.length("b"))).alias("at"))
        front, back = F.substring("b", F.lit(1), F.col("at") - 1), F.substring("b", F.col("at") + 1, F.length("b"))
        at = at.filter(F.substring("b", F.col("at"), F.lit(1)) != mask)
        less = at.select("key", "id", "indexed", F.concat(front, back).alias("b"), "masked", F.col("lost") + 1)
        hidden = at.select("key", "id", "indexed", F.concat(front, F.lit(mask), back).alias("b"), F.col("masked") + 1, "lost")
        forms = less.union(hidden).toDF(*found.columns)
        found = found.union(forms)
    # Of the ways to one form the one that loses least; the others make the same pairs.
    found = found.groupBy("key", "id", "indexed", F.xxhash64("b").alias("form"), "masked").agg(F.min("lost").alias("lost"))
    found = written(dealt(found, tasks), "line-forms")
    return paired(found, ["key", "form", "masked"], F.col("masked") + F.col("x_lost") + F.col("y_lost") <= edits).distinct()


def halves(longest: int) -> Column:
    """Powers of two that add up to at least `longest`, the largest first."""
    return F.array(*[F.lit(1 << k) for k in range(max(1, longest).bit_length() - 1, -1, -1)])


def agreement(x: Column, y: Column, least: Column, steps: Column, place: Callable[[Column, Column, Column], Column] = lambda c, n, s: F.substring(c, n + 1, s)) -> Column:
    """How many bytes, `least` at most, x and y begin with in common: each step compares two substrings."""
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when((n + s <= least) & (place(x, n, s) == place(y, n, s)), n + s).otherwise(n))


def stripped(pairs: DataFrame, longest: int) -> DataFrame:
    """pairs with strings x and y, none longer than `longest`, without what they begin and end with in common.

    How far they agree is found by halving: each step compares two substrings.
    """
    steps, x, y, least = halves(longest), F.col("x"), F.col("y"), F.least(F.length("x"), F.length("y"))
    ends = {"front": agreement(x, y, least, steps), "back": agreement(x, y, least, steps, lambda c, n, s: F.substring(c, F.length(c) - n - s + 1, s))}
    pairs = pairs.withColumns(ends).withColumn("back", F.least("back", least - F.col("front")))
    return pairs.withColumns({c: F.substring(c, F.col("front") + 1, F.length(c) - F.col("front") - F.col("back")) for c in "xy"}).drop("front", "back")


def within(x: Column, y: Column, edits: int) -> Column:
    """Whether two byte strings, not longer than each other by more than `edits`, are within `edits` edits.

    In column j of the dynamic programme only the rows j - edits .. j + edits matter; bit d of the numbers is row
    j - edits + d. The distance is followed down the lowest of these diagonals to the last row, and then
    along that row. Arrays of characters, so that each is found at once.
    """
    width, mask = 2 * edits + 1, (1 << (2 * edits + 1)) - 1
    text = F.split(y, "")
    padded = F.concat(F.array_repeat(F.lit(""), edits), F.split(x, ""), F.array_repeat(F.lit(""), width))
    # What a lambda refers to outside itself is evaluated for each element, so the bits of all columns are made first,
    # by zipping the text with the pattern at each of the band's shifts, and lengths travel in the state.
    def hits(d: int) -> Column:
        return F.zip_with(F.slice(padded, d + 1, F.length(y)), text, lambda a, b: F.when(a == b, 1 << d).otherwise(0))

    matches = hits(0)
    for d in range(1, width):
        matches = F.zip_with(matches, hits(d), lambda a, b: a + b)

    def column(s: Column, pm: Column) -> Column:
        vp, vn = s["vp"], s["vn"]
        d0 = ((pm.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(pm).bitwiseOR(vn).bitwiseAND(F.lit(mask))
        return F.struct(d0.alias("d0"), vp.alias("vp"), vn.alias("vn"), s["dist"].alias("dist"), s["left"].alias("left"))

    def step(t: Column) -> Column:
        d0, vp, vn, left = t["d0"], t["vp"], t["vn"], t["left"]
        hp, hn = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))), d0.bitwiseAND(vp)
        row = left - 1 + edits  # bit of the last row in this column
        bit = lambda v, at: F.call_function("shiftright", v.bitwiseAND(F.lit(mask)), at).bitwiseAND(F.lit(1))
        down = 1 - bit(d0, F.lit(width - 1))
        along = bit(hp, row) - bit(hn, row)
        shifted = F.shiftright(d0, 1)
        return F.struct(
            hn.bitwiseOR(F.bitwise_not(shifted.bitwiseOR(hp))).bitwiseAND(F.lit(mask)).alias("vp"), shifted.bitwiseAND(hp).bitwiseAND(F.lit(mask)).alias("vn"),
            (t["dist"] + F.when(left > edits, down).otherwise(along)).alias("dist"), (left - 1).alias("left"),
        )

    # left: rows of the pattern below this column's diagonal. The one-element array names what is used more than once.
    start = F.struct(F.lit(((1 << (edits + 1)) - 1) << edits).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("dist"), F.length(x).alias("left"))
    end = F.aggregate(matches, start, lambda s, pm: F.get(F.transform(F.array(column(s, pm)), step), F.lit(0)))
    return end["dist"] <= edits


def distinct_lines(docs: DataFrame, row: str, least: int, id_col: str, text_col: str) -> DataFrame:
    """h1, h2, first place, times, bytes b and their number n of each distinct line; written once, and packed well, as it stays while much is shuffled."""
    lines = lines_of(docs, row, least, id_col, text_col)
    once = lines.groupBy(*LINE).agg(F.first("line").alias("line"), F.min(F.struct("doc_id", "row", "pos")).alias("first"), F.count("*").alias("times"))
    return written(once.select(*LINE, "first", "times", as_bytes(F.col("line")).alias("b"), F.octet_length("line").alias("n")), "lines", codec="zstd")


def near_lines(distinct: DataFrame, edits: int) -> DataFrame:
    """h1, h2, first, n_links and near (whether a link leads to an earlier line) of each distinct line within `edits` edits of another."""
    pairs = candidate_pairs(distinct, edits)
    needed = written(pairs.select(F.explode(F.array("x", "y")).alias("h1")).distinct(), "line-needed")
    texts = written(distinct.join(few(needed), "h1", "left_semi").select("h1", "n", F.struct("first", *LINE).alias("line"), "b"), "line-texts")
    release_after(needed)
    longest = texts.agg(F.max("n")).first()[0] or 0
    both = pairs.withColumnsRenamed({"x": "i", "y": "k"})
    for end, name in (("i", "x"), ("k", "y")):
        both = both.join(texts.select(F.col("h1").alias(end), F.col("line").alias(f"{name}_line"), F.col("b").alias(name)), end)
    both = both.filter(F.abs(F.length("x") - F.length("y")) <= edits).select("x_line", "y_line", "x", "y")
    both = written(stripped(both, longest), "line-pairs")  # else what is stripped would be worked out again for every byte that is compared
    near = F.when(F.greatest(F.length("x"), F.length("y")) <= edits, True).otherwise(within(F.col("x"), F.col("y"), edits))
    links = both.filter(near).select(F.least("x_line", "y_line").alias("early"), F.greatest("x_line", "y_line").alias("late"))
    ends = links.select(F.explode(F.array(F.struct(F.col("early").alias("line"), F.lit(False).alias("near")), F.struct(F.col("late").alias("line"), F.lit(True).alias("near")))).alias("e"))
    return ends.groupBy("e.line.h1", "e.line.h2").agg(F.min("e.line.first").alias("first"), F.count("*").alias("n_links"), F.max("e.near").alias("near"))


def removed_lines(docs: DataFrame, row: str, least: int, edits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, pos, near) of every line that goes, and the rows of near_lines.

    Tables of lines, and what was shuffled to make them, are gone before the documents are shuffled.
    """
    with scratch(docs.sparkSession):
        distinct = distinct_lines(docs, row, least, id_col, text_col)
        release(docs.sparkSession)  # the lines were shuffled once and now are in a table
        near = written(near_lines(distinct, edits), "line-near", outside=True)
        verdicts = distinct.filter("times > 1").select(*LINE, "first").join(near.filter("near").select(*LINE, "near"), LINE, "left")
        verdicts = verdicts.unionByName(near.filter("near").select(*LINE, "first", "near").join(distinct.filter("times > 1").select(*LINE), LINE, "left_anti"))
        verdicts = written(verdicts.select(*LINE, "first", F.coalesce("near", F.lit(False)).alias("near")), "line-verdicts", outside=True)
    release(docs.sparkSession)
    light = lines_of(docs, row, least, id_col, text_col).select("doc_id", "row", "pos", *LINE)
    if verdicts.count() <= BROADCAST_LINES:
        again = light.join(F.broadcast(verdicts), LINE)
    else:
        light = written(light.withColumn("run", F.spark_partition_id()), "line-places")
        again = light.join(light.select("run", *LINE).distinct().join(verdicts, LINE), ["run", *LINE])
    again = again.select("doc_id", "row", "pos", "near", (F.struct("doc_id", "row", "pos") == F.col("first")).alias("is_first"))
    return again.filter("near OR NOT is_first").select("doc_id", "row", "pos", "near"), near


def line_report(docs: DataFrame, least: int = 20, edits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_exact, n_near, removed (positions from 0, comma-separated), n_links for each document.

    n_exact counts removed lines without an earlier line near to but different from them, n_near the other removed ones; n_links counts
    pairs of different lines of which one first stands in the document.
    """
    docs, row = keyed(docs.select(id_col, text_col), id_col)
    gone, near = removed_lines(docs, row, least, edits, id_col, text_col)
    by_doc = gone.groupBy("doc_id", "row").agg(F.count_if(~F.col("near")).alias("n_exact"), F.count_if("near").alias("n_near"), F.array_join(F.sort_array(F.collect_list("pos")), ",").alias("removed"))
    ends = near.groupBy("first.doc_id", "first.row").agg(F.sum("n_links").alias("n_links"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(row).alias("row"), F.coalesce(F.size(F.split(F.col(text_col), "\n", -1)), F.lit(0)).cast("long").alias("n_lines"))
    return _joined(_joined(rows, by_doc), ends).select(
        "doc_id", "n_lines", F.coalesce("n_exact", F.lit(0)).alias("n_exact"), F.coalesce("n_near", F.lit(0)).alias("n_near"), F.coalesce("removed", F.lit("")).alias("removed"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _joined(rows: DataFrame, more: DataFrame) -> DataFrame:
    more = more.withColumnsRenamed({"doc_id": "_id", "row": "_of"})
    return rows.join(more, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_of")), "left").drop("_id", "_of")


def deduplicated(docs: DataFrame, least: int = 20, edits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without the lines that go; documents that lose all their lines go too."""
    columns, (docs, row) = docs.columns, keyed(docs, id_col)
    of_id, of_row, places = (unused(c, docs) for c in ("_id", "_of", "_gone"))
    gone, _ = removed_lines(docs, row, least, edits, id_col, text_col)
    by_doc = gone.groupBy(F.col("doc_id").alias(of_id), F.col("row").alias(of_row)).agg(F.collect_set("pos").alias(places))
    rows = docs.join(by_doc, F.col(id_col).cast("long").eqNullSafe(F.col(of_id)) & (F.col(row) == F.col(of_row)), "left")
    stays = F.filter(F.split(F.col(text_col), "\n", -1), lambda _, i: ~F.array_contains(F.col(places), i))
    rows = rows.filter(F.col(places).isNull() | (F.size(stays) > 0))
    return rows.withColumn(text_col, F.when(F.col(places).isNull(), F.col(text_col)).otherwise(F.array_join(stays, "\n"))).select(*columns)
