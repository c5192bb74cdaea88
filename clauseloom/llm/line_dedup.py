"""Line dedup by a segment-partition edit join, with DataFrame functions only.

Equal lines are one class, known by 128 bits of hash.  Classes of at least ``MIN_CHARS`` code points are linked where their edit
distance is at most ``EDITS``; of each group of linked classes, the first occurrence in (doc_id, text, line number) order is kept.

**Join.** A line within ``EDITS`` edits of another keeps one of the other's ``EDITS`` + 1 segments unchanged.  Every line is indexed by
its length and segments, and looks up, for its own length and those up to ``EDITS`` below, the substrings at the few
places where an unchanged segment can stand.  Keys that only one class has are dropped before anything is joined.
**Rounds.** Inside a key not all pairs are formed, since variants of one line would give a square of them.  The commonest indexed line of
the key leads, and the others meet it; links join classes into groups; in the next round four times as many leaders
meet those that are still in other groups, until every key holds one group or all its indexed lines have led.  What is
never compared lies in one group already, so the groups are those of all pairs.  Counts of letters and maps of letter pairs that are
further apart than the edits allow end a pair inside the join.
**Verification.** Banded bit-parallel edit distance: the 2 x ``EDITS`` + 1 rows of a column are bits of one number, and one
step per character moves the band along the diagonal.  Prefixes and suffixes in common are cut off before.

Lines are separated by line feeds; those without a word are kept and never counted.  Null and empty texts have no lines and stay
as they are.  Rows that repeat an id and a text are one document.  Columns of ``docs`` pass through; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clauseloom.session import written

from .near_dedup import components
from .registry import discard

EDITS, MIN_CHARS = 2, 40
LETTERS = string.ascii_lowercase + " ,.-:"  # 31 counts of two bits share a number
MORE_LETTERS = "abcdefghiklmnoprstuvwyz,. "  # counted in full once the texts of a pair are at hand
MORE_LEADERS = 4  # times as many in each round
MAX_BROADCAST = 500_000  # keys, or places of lines of five numbers each
_WORD = r"[^\x20\x09-\x0D]"
ROW = ["doc_id", "row_hash"]  # a row of the table; the hash tells rows of one id apart
PLACE = [*ROW, "line_no"]


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.xxhash64("doc_id", text).alias("row_hash"), F.split(text, "\n", -1).alias("lines"))


def _numbered(docs: DataFrame) -> DataFrame:
    """Lines with a word: doc_id, row_hash, line_no, line."""
    lines = _rows(docs).select(*ROW, F.posexplode("lines").alias("line_no", "line"))
    return lines.where(F.col("line").rlike(_WORD))


def _letters() -> Column:
    packed = F.lit(0).cast("long")
    for k, letter in enumerate(LETTERS):
        count = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(letter), F.lit("")))
        packed = packed.bitwiseOR(F.shiftleft(count.bitwiseAND(F.lit(3)).cast("long"), 2 * k))
    return packed


def _letters_apart(a: str, b: str) -> Column:
    """A lower bound of twice the edits from the packed letter counts, which are known modulo 4.

    Apart modulo 4: 0, 1, 2, 1 for a difference of 0, 1, 2, 3.  In each pair of bits, the low bit of the difference adds 1, and the
    high bit alone adds 2.
    """
    low = F.lit(0x5555555555555555).cast("long")
    x, y = F.col(a), F.col(b)
    # x - y in every pair of bits at once, without borrowing from the next
    ones = x.bitwiseXOR(y).bitwiseAND(low)
    borrowed = y.bitwiseAND(F.bitwise_not(x)).bitwiseAND(low)
    twos = F.shiftrightunsigned(x.bitwiseXOR(y), 1).bitwiseAND(low).bitwiseXOR(borrowed).bitwiseAND(F.bitwise_not(ones))
    return F.bit_count(ones) + 2 * F.bit_count(twos)


def _letter_pairs() -> Column:
    """Two maps of 64 bits each: whether a pair of neighbouring letters with that hash occurs an odd number of times."""
    bit = lambda h, half: F.when(F.shiftright(h, 6).bitwiseAND(F.lit(1)) == half, F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)))).otherwise(F.lit(0).cast("long"))
    fold = lambda hashes, half: F.aggregate(hashes, F.lit(0).cast("long"), lambda odd, h: odd.bitwiseXOR(bit(h, half)))
    pairs = lambda letters: F.transform(letters, lambda c, i: F.hash(c, F.get(letters, i + 1)))
    once = lambda value, use: F.get(F.transform(F.array(value), use), 0)
    return once(F.split("line", ""), lambda letters: once(pairs(letters), lambda hashes: F.struct(fold(hashes, 0).alias("low"), fold(hashes, 1).alias("high"))))


def _may_be_close(a: str, b: str, edits: int) -> Column:
    """False only for lines further apart than ``edits``.

    A replaced letter changes two letter counts and four letter pairs at most, an added or removed one changes one count and three
    pairs; lines that differ in length by n have n of the latter at least.
    """
    odd = sum(F.bit_count(F.col(f"{a}.pairs.{half}").bitwiseXOR(F.col(f"{b}.pairs.{half}"))) for half in ("low", "high"))
    longer = F.abs(F.col(f"{a}.size") - F.col(f"{b}.size"))
    return (longer <= edits) & (odd <= 4 * edits - longer) & (_letters_apart(f"{a}.letters", f"{b}.letters") <= 2 * edits - longer)


def _hashes() -> tuple[Column, Column]:
    return F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")


def classes_of(lines: DataFrame) -> DataFrame:
    """Distinct lines by their hashes: h1, h2, and doc_id, row_hash and line_no of the first occurrence."""
    places = lines.select(*_hashes(), F.struct(*PLACE).alias("place"))
    return places.groupBy("h1", "h2").agg(F.min("place").alias("first")).select("h1", "h2", "first.*")


def _segment(size: Column, i: int, edits: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment ``i`` of a line of ``size`` code points."""
    parts = edits + 1
    base, longer = F.floor(size / parts).cast("int"), (size % parts).cast("int")
    short = F.lit(parts) - longer  # so many segments come before the longer ones
    return base * i + F.greatest(F.lit(0), F.lit(i) - short), base + F.when(F.lit(i) >= short, 1).otherwise(0)


def _key(size: Column, i: int, start: Column, length: Column) -> Column:
    return F.xxhash64(size, F.lit(i), F.substring("line", start + 1, length))


def keyed_lines(lines: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """h1, h2 of each line, its keys for the index (``own``) and those that it looks up (``probes``).

    The keys are worked out where the lines are read.  A line looks up its own segments by being in the index itself.
    """
    size = F.col("size")
    own = [_key(size, i, *_segment(size, i, edits)) for i in range(edits + 1)]
    probes: list[Column] = []
    for shorter in range(edits + 1):
        theirs = size - shorter
        for i in range(edits + 1):
            start, length = _segment(theirs, i, edits)
            left, right = edits - i, i  # edits that may lie behind and before the segment
            for shift in range(max(-right, shorter - left), min(right, shorter + left) + 1):
                if shorter or shift:
                    probes.append(F.when(theirs >= min_chars, _key(theirs, i, start + shift, length)))
    sized = lines.select("line", F.char_length("line").alias("size")).where(size >= min_chars)
    return sized.select(*_hashes(), F.array(*own).alias("own"), F.array(*probes).alias("probes"))


def _entries(keyed: DataFrame) -> DataFrame:
    """key, h1, h2, and whether the key is in the index."""
    sides = [keyed.select(F.explode(side).alias("key"), "h1", "h2", F.lit(side == "own").alias("indexed")) for side in ("own", "probes")]
    return sides[0].unionByName(sides[1].where("key is not null"))


def shared_keys(lines: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """key, h1, h2, indexed, n (occurrences): the entries of all keys that different lines have, one of them in the index."""
    keyed = written(keyed_lines(lines, edits, min_chars), "line-keys")
    groups = _entries(keyed).groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"), F.max("indexed").alias("indexed"))
    shared = written(groups.where("low <> high and indexed").select("key"), "shared-keys")
    wanted = F.broadcast(shared) if shared.count() <= MAX_BROADCAST else shared
    entries = _entries(keyed).join(wanted, "key", "left_semi").groupBy("key", "h1", "h2", "indexed").agg(F.count("*").alias("n"))
    entries = written(entries, "shared-entries")
    discard(keyed)
    return entries


def _common_prefix(a: Column, b: Column, most: Column) -> Column:
    """Code points that two texts have in common at the start, found by halving."""
    state = lambda low, high: F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"] + 1) / 2).cast("int")
        same = F.substring(a, F.lit(1), middle) == F.substring(b, F.lit(1), middle)
        return F.when(s["low"] >= s["high"], s).when(same, state(middle, s["high"])).otherwise(state(s["low"], middle - 1))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(most, F.lit(1)) + 1)).cast("int"))
    return F.aggregate(steps, state(F.lit(0), most), halve, lambda s: s["low"])


def trimmed(a: Column, b: Column) -> Column:
    """Two texts without what they have in common at the start, as a struct of a and b."""
    shortest = F.least(F.char_length(a), F.char_length(b))
    start = _common_prefix(a, b, shortest)
    rest = lambda t: F.substring(t, start + 1, F.char_length(t))
    return F.struct(rest(a).alias("a"), rest(b).alias("b"))


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether the edit distance is at most ``edits``: banded, a bit per row of the band, a step per character of ``b``.

    Bit i of column j stands for row j - edits + i.  Rows outside ``a`` match nothing.  ``at`` is the distance at the band's last
    row; the distance at the end of ``a`` follows from the vertical steps between.
    """
    # split and measured once, and handed on by name
    letters = F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y"), F.char_length(a).alias("m"), F.char_length(b).alias("n"))
    return F.get(F.transform(F.array(letters), lambda v: _within(v["x"], v["y"], v["m"], v["n"], edits)), 0)


def _within(x: Column, y: Column, m: Column, n: Column, edits: int) -> Column:
    width = 2 * edits + 1
    whole = (1 << width) - 1
    L = lambda v: F.lit(v).cast("long")  # noqa: E731, N806
    band = lambda plus, minus, at: F.struct(plus.alias("plus"), minus.alias("minus"), at.alias("at"))

    def step(s: Column, j: Column) -> Column:
        letter = F.get(y, j - 1)
        match = L(0)
        for i in range(width):
            row = j - edits + i
            match = match + F.when((row >= 1) & (row <= m) & (F.get(x, row - 1) == letter), L(1 << i)).otherwise(L(0))
        # computed once each: the lambda of transform names its argument
        def moved(match: Column) -> Column:
            # the vertical steps of column j - 1 belong to rows one lower in this column's band
            plus, minus = s["plus"], s["minus"]
            diagonal = ((match.bitwiseAND(plus) + plus).bitwiseXOR(plus)).bitwiseOR(match).bitwiseOR(minus).bitwiseAND(L(whole))
            return F.get(F.transform(F.array(diagonal), lambda d: _next(d, plus, minus, s["at"])), 0)

        def _next(d: Column, plus: Column, minus: Column, at: Column) -> Column:
            up = minus.bitwiseOR(L(whole).bitwiseXOR(d.bitwiseOR(plus)))
            down = d.bitwiseAND(plus)
            shifted = F.shiftright(d, 1)
            new_plus = down.bitwiseOR(L(whole).bitwiseXOR(shifted.bitwiseOR(up).bitwiseAND(L(whole)))).bitwiseAND(L(whole))
            return band(new_plus, shifted.bitwiseAND(up), at + F.when(d.bitwiseAND(L(1 << (width - 1))) == 0, 1).otherwise(0))

        return F.get(F.transform(F.array(match), moved), 0)

    # column 0: row r is r away; rows 1 to edits + 1 are one step apart, those above the text are level
    start = band(L(whole & ~((1 << edits) - 1)), L(0), F.lit(edits))
    last = F.when(n > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), start, step)).otherwise(start)
    return F.get(F.transform(F.array(last), lambda s: _at_end(s, m, n, edits)), 0)


def _at_end(last: Column, m: Column, n: Column, edits: int) -> Column:
    L = lambda v: F.lit(v).cast("long")  # noqa: E731, N806
    width = 2 * edits + 1
    # after column n, bit i is the step from row n - edits + i to the next; take back the steps from row m to row n + edits
    back = L(0)
    for i in range(width - 1):
        beyond = (n - edits + i) >= m
        bit = L(1 << i)
        change = F.when(last["plus"].bitwiseAND(bit) != 0, 1).otherwise(0) - F.when(last["minus"].bitwiseAND(bit) != 0, 1).otherwise(0)
        back = back + F.when(beyond, change).otherwise(0)
    return (F.abs(m - n) <= edits) & ((last["at"] - back) <= edits)


def candidate_lines(docs: DataFrame, classes: DataFrame, entries: DataFrame) -> DataFrame:
    """node (a number), h1, h2, place, line, size, letters and pairs (of letters) of every class in ``entries``; ``classes`` and ``entries`` are written tables."""
    places = classes.join(entries.select("h1", "h2").distinct(), ["h1", "h2"])
    places = written(places.withColumn("node", F.monotonically_increasing_id()), "line-places")
    # beyond the bound the places are shuffled like any table
    wanted = F.broadcast(places) if places.count() <= MAX_BROADCAST else places
    rows = _rows(docs).alias("r").join(wanted.alias("w"), F.col("r.row_hash").eqNullSafe(F.col("w.row_hash")) & F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")))
    found = rows.select("node", "h1", "h2", F.struct(*[F.col(f"w.{c}") for c in PLACE]).alias("place"), F.get("lines", F.col("line_no")).alias("line"))
    lines = written(found.distinct(), "candidate-lines")
    discard(places)
    measured = written(lines.withColumns({"size": F.char_length("line"), "letters": _letters(), "pairs": _letter_pairs()}), "candidate-lines")
    discard(lines)
    return measured


def close_pairs(pairs: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    """The pairs (a, b) of nodes whose lines are within ``edits`` edits."""
    texts = lines.select("node", "line")
    both = pairs.join(texts.toDF("a", "line_a"), "a").join(texts.toDF("b", "line_b"), "b")
    # written step by step: each step names its texts many times, and nested they would be worked out as often
    counts = [F.octet_length(F.replace("line_a", F.lit(c), F.lit(""))) - F.octet_length("line_a") - F.octet_length(F.replace("line_b", F.lit(c), F.lit("")))
              + F.octet_length("line_b") for c in MORE_LETTERS]
    both = both.where(sum((F.abs(c) for c in counts), F.lit(0)) <= 2 * edits)  # an edit changes two counts by one at most
    cut = written(both.select("a", "b", trimmed(F.col("line_a"), F.col("line_b")).alias("t")), "pairs-cut")
    ends = written(cut.select("a", "b", trimmed(F.reverse("t.a"), F.reverse("t.b")).alias("t")), "pairs-cut")  # and from the ends
    close = ends.select("a", "b", F.col("t.a").alias("x"), F.col("t.b").alias("y"))
    close = close.where(F.abs(F.char_length("x") - F.char_length("y")) <= edits).where(within_edits(F.col("x"), F.col("y"), edits))
    links = written(close.select("a", "b"), "line-links")
    for used in (cut, ends):
        discard(used)
    return links


def line_groups(docs: DataFrame, classes: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """place and first: of every class that is linked with others, and the first one of its group; ``classes`` is a written table."""
    shared = shared_keys(_numbered(docs), edits, min_chars)
    lines = candidate_lines(docs, classes, shared)
    entries = written(shared.join(lines.select("h1", "h2", "node", "size", "letters", "pairs"), ["h1", "h2"]).drop("h1", "h2"), "line-entries")
    discard(shared)
    groups, led, leaders = None, 0, 1
    while True:
        placed = entries.withColumn("group", F.col("node")) if groups is None else entries.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("component")
        # pairs are left where an indexed line has not led yet and another is in a different group
        keys = placed.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("entries"), F.count(F.when(F.col("indexed"), 1)).alias("indexes"))
        open_keys = keys.where((F.col("low") != F.col("high")) & (F.col("entries") - led >= 2) & (F.col("indexes") > led)).select("key")
        open_ = written(placed.join(open_keys, "key", "left_semi"), "open-lines")
        if open_.isEmpty():
            break
        order = Window.partitionBy("key").orderBy(F.desc("n"), F.xxhash64("node", "key"), "node")
        turn = F.row_number().over(order)
        chosen = open_.where("indexed").withColumn("turn", turn).where((F.col("turn") <= led + leaders) & (F.col("turn") > led))
        p, q = chosen.alias("p"), open_.alias("q")
        met = q.join(p, (F.col("p.key") == F.col("q.key")) & (F.col("p.group") != F.col("q.group")) & _may_be_close("p", "q", edits))
        pairs = written(met.select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct(), "line-pairs")
        links = close_pairs(pairs, lines, edits)
        if groups is None:
            groups = components(links)
        elif not links.isEmpty():
            groups = merged(groups, links)
        led, leaders = led + leaders, leaders * MORE_LEADERS
        discard(open_)
    if groups is None:
        groups = entries.select("node", F.col("node").alias("component")).where("false")
    members = lines.select("node", "place").join(groups, "node")
    first = members.groupBy("component").agg(F.min("place").alias("first"))
    return written(members.join(first, "component").select("place", "first"), "line-groups")


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) after ``links`` (a, b) between their nodes and others."""
    a, b = groups.toDF("a", "component_a"), groups.toDF("b", "component_b")
    between = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("component_a", "a").alias("a"), F.coalesce("component_b", "b").alias("b"))
    above = components(between).toDF("component", "whole")
    moved = groups.join(above, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    new = above.select(F.col("component").alias("node"), F.col("whole").alias("component")).join(groups.select("node"), "node", "left_anti")
    return written(moved.unionByName(new), "groups")


def judge_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, row_hash, n_lines, n_dup_lines, n_near_lines, kept_lines, near_of: one row per different row with lines.

    ``n_dup_lines`` counts lines dropped because an equal one comes first, ``n_near_lines`` those dropped because a line of their
    group does; ``kept_lines`` numbers what stays.  ``near_of`` has the line numbers of the latter, each with doc_id and
    line number of the first line of its group.
    """
    classes = written(classes_of(_numbered(docs)), "line-classes")
    groups = line_groups(docs, classes, edits, min_chars)
    # groups are added to the classes by grouping: both are one row per place at most
    late = groups.where("place <> first").select("place.*", F.struct("first.doc_id", "first.line_no").alias("near"))
    places = classes.select(*PLACE, F.lit(None).cast(late.schema["near"].dataType).alias("near"))
    merged_ = places.unionByName(late).groupBy(*PLACE).agg(F.max("near").alias("near"))
    per_row = merged_.groupBy(*ROW).agg(
        F.count("*").alias("firsts"), F.count("near").alias("near"),
        F.array_sort(F.collect_list(F.when(F.col("near").isNull(), F.col("line_no")))).alias("kept_lines"),
        F.array_sort(F.collect_list(F.when(F.col("near").isNotNull(), F.struct("line_no", "near.doc_id", F.col("near.line_no").alias("first_line_no"))))).alias("near_of"))
    total = _rows(docs).select(*ROW, F.size(F.filter("lines", lambda line: F.rlike(line, F.lit(_WORD)))).cast("long").alias("n_lines"))
    total = total.where("n_lines > 0").groupBy(*ROW).agg(F.max("n_lines").alias("n_lines"))
    joined = total.alias("t").join(per_row.alias("k"), F.col("t.row_hash").eqNullSafe(F.col("k.row_hash")) & F.col("t.doc_id").eqNullSafe(F.col("k.doc_id")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return joined.select("t.doc_id", "t.row_hash", "n_lines", (F.col("n_lines") - zero("firsts")).alias("n_dup_lines"), zero("near").alias("n_near_lines"),
                         F.coalesce("kept_lines", F.array().cast("array<int>")).alias("kept_lines"),
                         F.coalesce("near_of", F.array().cast(per_row.schema["near_of"].dataType)).alias("near_of"))


def without_repeated_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the lines that are kept as ``text``; documents that had lines with words and keep none are dropped."""
    judged = written(judge_lines(docs.select("doc_id", "text"), edits, min_chars), "judged-lines").alias("j")
    own = F.col("d.text").cast("string")
    joined = docs.alias("d").join(judged, (F.xxhash64("d.doc_id", own) == F.col("j.row_hash")) & F.col("d.doc_id").eqNullSafe(F.col("j.doc_id")), "left")
    known = F.col("j.row_hash").isNotNull()
    kept = joined.where(~known | (F.size("j.kept_lines") > 0))
    bound = lambda lines: F.array_join(F.transform(F.array_sort(F.concat(
        F.col("j.kept_lines"), F.filter(F.transform(lines, lambda line, i: F.when(~F.rlike(line, F.lit(_WORD)), i)), lambda i: i.isNotNull()))),
        lambda i: F.get(lines, i)), "\n")
    text = F.when(known, F.get(F.transform(F.array(F.split(own, "\n", -1)), bound), 0)).otherwise(own)
    return kept.select(*[text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns])
