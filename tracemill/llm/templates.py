"""Line dedup by a log-template tree.

Lines go down a tree of fixed depth: by token count, then by leading tokens.
Tokens with a digit are variable fields from the start. In a leaf the most
frequent line leads a template, and lines that agree with it on enough
positions are the same template, their other positions being variable too.
More leaders are elected, ever more a round, until every line of the leaf leads
or is led. A template that recurs in several documents stays in the first of
them and is dropped from the others.

Only hashes travel: of a line its digest, its leaves and a 32-bit hash of each
token, which is what agreement is judged by: two different tokens pass as equal
once in four billion.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tracemill.llm.common import free_name, table, text_of
from tracemill.session import spool

# Leading tokens of the leaves.
DEPTHS = (3,)
# A leaf has one leader in the first round and so many times as many in each further one.
MORE_LEADERS = 16
# So many leaf hashes, 8 bytes each, are sent to every executor; more are joined.
FEW_LEAVES = 500_000
# Share of positions a line has in common with the template's leader.
AGREEMENT = 0.85
# A template is dropped from this many documents on; lines without a token are left alone.
MIN_DOCS, MIN_TOKENS = 2, 1
# Shorter lines have no variable fields: they are a template with equal lines only.
MIN_FIELDS = 5

FIELD = "<*>"


def _blanks(line: Column) -> Column:
    return F.when(line.rlike(r"[\t\x0B\f\r]"), F.translate(line, "\t\x0b\x0c\r", "    ")).otherwise(line)


def _split(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def fields_of(line: Column) -> Column:
    """Blank-separated tokens, those with a digit as a variable field."""
    blanks = _blanks(line)
    return _split(F.when(line.rlike("[0-9]"), F.regexp_replace(blanks, "[^ 0-9]*+[0-9][^ ]*+", FIELD)).otherwise(blanks))


def tokens_of(line: Column, fields: Column) -> Column:
    """The fields in lines of `MIN_FIELDS` or more, in others the tokens as they are."""
    return F.when(F.size(fields) >= MIN_FIELDS, fields).otherwise(_split(_blanks(line)))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line with a token: where it stands, its digest, its leaves and its shape."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("body"), F.split(text, "\n").alias("lines"))
    # Conditions on what is costly to make, stated or inferred, would have it made twice: a text has a line at least,
    # and a line a token if anything but blanks is in it.
    rows = rows.select("doc_id", "body", F.posexplode_outer("lines").alias("line_no", "line"))
    rows = rows.filter(F.col("line").rlike(r"[^ \t\x0B\f\r]"))
    rows = rows.withColumn("fields", fields_of(F.col("line")))
    rows = rows.select("doc_id", "body", "line_no", tokens_of(F.col("line"), F.col("fields")).alias("tokens"))
    # A short line has a leaf of its own, where only equal lines are.
    leading = lambda d: F.when(F.size("tokens") >= MIN_FIELDS, F.slice("tokens", 1, d)).otherwise(F.col("tokens"))
    leaf = lambda d: F.xxhash64(F.size("tokens"), leading(d))
    return rows.select(
        "doc_id",
        "body",
        "line_no",
        F.xxhash64("tokens").alias("h1"),
        F.xxhash64(F.lit(1), "tokens").alias("h2"),
        *[leaf(d).alias(f"leaf{i}") for i, d in enumerate(DEPTHS)],
        F.when(F.size("tokens") >= MIN_FIELDS, F.transform("tokens", lambda t: F.hash(t))).alias("shape"),
    )


def agreement(a: Column, b: Column) -> Column:
    """Share of equal positions of two shapes of one length."""
    equal = F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0))
    return F.aggregate(equal, F.lit(0), lambda n, x: n + x) / F.size(a)


def _slices(shape: str, agreed: float) -> Column:
    """Keys of a line of which two agreeing lines of a leaf share one at least.

    The positions behind the leaf's own are cut into one slice more than lines
    may differ in positions, so one slice is equal.
    """
    first, length = max(DEPTHS), F.size(shape)
    cuts = F.floor((1 - agreed) * length + 1e-6).cast("int") + 1
    start = lambda i: F.floor(i * (length - first) / cuts).cast("int")
    piece = lambda i: F.slice(shape, start(i) + first + 1, start(i + 1) - start(i))
    return F.transform(F.sequence(F.lit(0), cuts - 1), lambda i: F.xxhash64("leaf0", i, piece(i)))


def _crowded(rest: DataFrame) -> DataFrame:
    """The lines of leaves that have two or more."""
    leaves = rest.groupBy("leaf0").agg(F.count("*").alias("n_lines")).filter("n_lines > 1").select("leaf0")
    return spool(rest.join(spool(leaves, "leaves"), "leaf0"), "unled")


def _leaders(lines: DataFrame, agreed: float) -> DataFrame:
    """(h1, h2, t1, t2): the lines that belong to another line's template, and that line.

    In rounds, until no leaf has two lines left. A leaf's lines are dealt over
    slots by hash, and the most frequent line of each slot stands as a leader;
    every line of the leaf that may agree with it is compared with it. Leaders no
    earlier leader agrees with leave with the lines they take. The first of a leaf is
    one of them, so each round settles some. Of equally frequent lines the one
    of the lesser digest leads, and a line that agrees with several leaders
    follows the most frequent of them, ties going to the lesser digest again.
    """
    # A line alone in its leaf leads itself.
    shared = lines.groupBy("leaf0").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    shared = spool(shared.filter("low < high").select("leaf0"), "shared-leaves")
    more = [F.first(c).alias(c) for c in ("shape", "leaf0")]
    # Few of all lines go on, so where their leaves are few too the others aren't moved to find that out.
    few = shared.limit(FEW_LEAVES + 1).count() <= FEW_LEAVES
    rest = lines.join(F.broadcast(shared) if few else shared, "leaf0").groupBy("h1", "h2").agg((-F.count("*")).alias("rank"), *more)
    rest = spool(rest, "distinct-lines")
    found, slots = None, 1
    while True:
        slot = F.pmod("h2", F.lit(slots)).alias("slot")
        lead = F.min(F.struct("rank", "h1", "h2", "shape")).alias("lead")
        fields = [F.col(f"lead.{c}").alias(n) for c, n in (("rank", "t_rank"), ("h1", "t1"), ("h2", "t2"), ("shape", "lead"))]
        leaders = spool(rest.groupBy("leaf0", slot).agg(lead).select("leaf0", *fields), "standing")
        other = (F.col("h1") != F.col("t1")) | (F.col("h2") != F.col("t2"))
        if slots == 1:
            pairs = rest.join(leaders, "leaf0").filter(other)
        else:
            of_line = rest.select("h1", "h2", F.explode(_slices("shape", agreed)).alias("key"))
            of_leader = leaders.select("t1", "t2", F.explode(_slices("lead", agreed)).alias("key"))
            pairs = of_line.join(of_leader, "key").filter(other).select("h1", "h2", "t1", "t2").distinct()
            pairs = spool(pairs, "pairs").join(rest.select("h1", "h2", "shape", "rank"), ["h1", "h2"])
            pairs = pairs.join(leaders.select("t1", "t2", "t_rank", "lead"), ["t1", "t2"])
        alike = (F.size("shape") == F.size("lead")) & (agreement(F.col("shape"), F.col("lead")) >= agreed)
        standing = leaders.select(F.col("t1").alias("h1"), F.col("t2").alias("h2"), F.lit(True).alias("leads"))
        # Of two leaders that agree only the first may take the other.
        later = F.struct("t_rank", "t1", "t2") < F.struct("rank", "h1", "h2")
        met = pairs.filter(alike).join(standing, ["h1", "h2"], "left").filter(F.isnull("leads") | later)
        met = spool(met.select("h1", "h2", "t1", "t2", "t_rank", "leads"), "met")
        taken = met.filter("leads").select(F.col("h1").alias("t1"), F.col("h2").alias("t2")).distinct()
        first = F.min(F.struct("t_rank", "t1", "t2")).alias("t")
        led = met.join(taken, ["t1", "t2"], "left_anti").groupBy("h1", "h2").agg(first)
        led = spool(led.select("h1", "h2", "t.t1", "t.t2"), "led")
        found = led if found is None else found.union(led)
        done = leaders.join(taken, ["t1", "t2"], "left_anti").select(F.col("t1").alias("h1"), F.col("t2").alias("h2"))
        rest = _crowded(rest.join(led.select("h1", "h2").union(done), ["h1", "h2"], "left_anti"))
        if rest.isEmpty():
            return spool(found, "leaders")
        slots = min(MORE_LEADERS * slots, 1 << 60)


def repeated_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, agreed: float = AGREEMENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, body, line_no) of the lines to drop; `body` is the xxhash64 of the text.

    Documents are told apart by id, a null id being one of its own and the
    last. The first document of a template keeps its lines.
    """
    lines = spool(_lines(docs, id_col, text_col), "lines", compression="zstd")
    leaders = _leaders(lines, agreed)
    rows = lines.select("doc_id", "body", "line_no", "h1", "h2").join(leaders, ["h1", "h2"], "left")
    rows = spool(
        rows.select("doc_id", "body", "line_no", F.coalesce("t1", "h1").alias("t1"), F.coalesce("t2", "h2").alias("t2")),
        "template-lines",
    )
    per_doc = rows.groupBy("t1", "t2", "doc_id").agg(F.lit(1).alias("one"))
    recurring = per_doc.groupBy("t1", "t2").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_id"))
    recurring = spool(recurring.filter(F.col("n_docs") >= min_docs), "recurring")
    return (
        rows.join(recurring, ["t1", "t2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select("doc_id", "body", "line_no")
    )


def drop_repeated(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    agreed: float = AGREEMENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    dropped_col: str | None = None,
) -> DataFrame:
    """`docs` with the lines of recurring templates taken out of their texts.

    Columns and rows stay, repeated rows too, with the text changed and, if
    named, the number of lines dropped in `dropped_col`. Null texts stay null,
    a text all of whose lines go becomes empty. Blank lines aren't counted as
    lines and stay.
    """
    drops = repeated_lines(docs, min_docs, agreed, id_col, text_col)
    key_id, body, drop = (free_name(docs, n) for n in ("dropped_id", "dropped_body", "drop"))
    drops = spool(
        drops.groupBy(F.col("doc_id").alias(key_id), F.col("body").alias(body)).agg(F.collect_set("line_no").alias(drop)), "drops"
    )
    text, lines, own = F.col(text_col), free_name(docs, "lines"), free_name(docs, "own_body")
    rows = docs.withColumn(own, F.xxhash64(text_of(text_col)))
    rows = rows.join(drops, rows[id_col].eqNullSafe(drops[key_id]) & (rows[own] == drops[body]), "left")
    rows = rows.withColumn(lines, F.when(F.col(drop).isNotNull(), F.split(text, "\n")))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    columns = [F.when(F.col(drop).isNull(), text).otherwise(left).alias(c) if c == text_col else F.col(c) for c in docs.columns]
    if dropped_col:
        columns.append(F.coalesce(F.size(drop), F.lit(0)).cast("long").alias(dropped_col))
    return rows.select(*columns)


def op1_line_templates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated(docs, dropped_col="n_dropped")
