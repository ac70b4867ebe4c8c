"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only.

Lines are compared as their words.  A line goes when an earlier line (by document id,
then line number) is equal, or is within one word of it: a word replaced, added or taken
away.  Lines under ``NEAR_WORDS`` words go only for equal ones, blank lines never.

Every line of n words has n variants with one word deleted.  Two lines are within one
word exactly if they have the same variant with the same place, or if one is a variant of
the other; so variants are keyed by hash, and of each key only the earliest line is kept
as the candidate: minima of groups instead of pairs of lines.  The candidate's words are
then compared.  A variant's hash is the exclusive-or of its words' hashes with their
places, so all n come from running totals.

Before that, a line that shares neither its first nor its last half with another line is
set aside: within one word at least one half stays as it is, so no neighbour is lost and
variants are made for few lines.

Defined results: a null text has no lines and stays null; ids that are null come first;
rows of one id are ordered by a hash of the row, equal rows keep the same lines; a line
equal to another by 128 bits of hash counts as equal; other columns pass through, and
those named like a result are replaced.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almanack.llm.base import packed, register, staged, table

NEAR_WORDS = 5
BLANKS = r"[\x20\x09-\x0D]+"
#: runs of blanks that are not a single space already
UNEVEN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def _lines(rows):
    """``row, doc_id, no, line``: the words of each line that is not blank, joined by spaces."""
    lines = rows.select("row", "doc_id", F.posexplode(F.split("text", "\n")).alias("no", "raw"))
    # asked of the raw line, or the replacement would be made once more for the filter
    lines = lines.where(F.col("raw").rlike(r"[^\x20\x09-\x0D]"))
    tidy = F.trim(F.regexp_replace("raw", UNEVEN, " "))
    return lines.select("row", "doc_id", "no", tidy.alias("line")).withColumns(
        {"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")}
    )


def _halves(near_words):
    """Keys of which two lines within one word share one: the first m and the last m words,
    m being half the words of the shorter line.  A line of n words is the shorter one, or
    equally long, with m = n DIV 2; as the longer one it has m = (n - 1) DIV 2, which is
    another number only for even n.  None for short lines."""

    def ends(m):
        m = f"CAST({m} AS INT)"
        return f"array(xxhash64(0, {m}, substring_index(line, ' ', {m})), xxhash64(1, {m}, substring_index(line, ' ', -{m})))"

    own = ends("n DIV 2")
    return F.when(F.col("n") >= near_words, F.expr(f"IF(n % 2 = 0, concat({own}, {ends('n DIV 2 - 1')}), {own})"))


def _only(rows, chosen, keys):
    """The ``rows`` whose ``keys`` are among the ``chosen``, which are distinct.

    Bits of the chosen ones' first key, in a table of at most 65,536 numbers whatever the
    corpus, are looked up before the join, so that few rows travel to it.
    """
    bit = f"CAST({keys[0]} & 63 AS INT)"
    word = F.shiftrightunsigned(keys[0], 48)
    bits = chosen.groupBy(word.alias("_word")).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("_bits"))
    seen = rows.withColumn("_word", word).join(F.broadcast(bits), "_word").where(f"(shiftrightunsigned(_bits, {bit}) & 1) = 1")
    # an inner join: a semi join would be moved ahead of the bits
    return seen.drop("_word", "_bits").join(chosen, keys)


def _slim(rows, near_words):
    """Place, hashes and keys of all lines, written once: the text is read once for it."""
    lines = _lines(rows).withColumn("n", F.length("line") - F.length(F.expr("replace(line, ' ', '')")) + 1)
    return staged(lines.select("row", "doc_id", "no", "h1", "h2", _halves(near_words).alias("keys")), "slim")


def _near(rows, slim):
    """``h1, h2`` of the distinct lines that have an earlier neighbour within one word."""
    place = F.struct("doc_id", "row", "no")
    keyed = slim.where("keys IS NOT NULL").select("h1", F.explode("keys").alias("key"))
    # equal lines have equal keys, so a key is shared if it has two different lines
    spread = keyed.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    shared = staged(spread.where("low <> high").select("key"), "shared")
    alive = staged(_only(keyed, shared, ["key"]).select("h1").distinct(), "halves")
    chosen = _only(_lines(rows), alive, ["h1"])
    chosen = chosen.groupBy("h1", "h2").agg(F.min(place).alias("at"), F.first("line").alias("line"))
    # numbered in the order of their places: from here on a number stands for line and place
    chosen = staged(chosen.orderBy("at").select(F.monotonically_increasing_id().alias("id"), "h1", "h2", "line"), "lines")

    # dealt out before the words are taken apart, so that the windows need no shuffle
    word = chosen.repartition("id").select("id", F.posexplode(F.split("line", " ")).alias("p", "word"))
    word = word.select("id", "p", F.xxhash64("word", "p").alias("own"), F.xxhash64("word", F.col("p") - 1).alias("back"))
    one = W.partitionBy("id")
    before = one.orderBy("p").rowsBetween(W.unboundedPreceding, -1)
    after = one.orderBy("p").rowsBetween(1, W.unboundedFollowing)
    none = F.lit(0).cast("long")
    lost = F.coalesce(F.bit_xor("own").over(before), none).bitwiseXOR(F.coalesce(F.bit_xor("back").over(after), none))
    variants = staged(word.select("id", "p", lost.alias("v"), (F.count("*").over(one) - 1).alias("size")), "variants")
    whole = staged(word.groupBy("id").agg(F.bit_xor("own").alias("v"), F.count("*").alias("size")), "wholes")

    # of a variant that several lines have at one place, the earliest line
    spots = variants.groupBy("v", "size", "p").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    spots = staged(spots.where("first <> last").drop("last"), "spots")
    same_place = _only(variants, spots, ["v", "size", "p"]).select("id", "p", F.col("first").alias("other"), F.col("p").alias("q"))
    # variants that are whole lines
    met = whole.groupBy("v", "size").agg(F.min("id").alias("first"))
    met = staged(_only(variants, met, ["v", "size"]), "met")
    shorter = met.select("id", "p", F.col("first").alias("other"), F.lit(-1).alias("q"))
    longer = whole.join(met.groupBy("v", "size").agg(F.min(F.struct("id", "p")).alias("early")), ["v", "size"])
    longer = longer.select("id", F.lit(-1).alias("p"), F.col("early.id").alias("other"), F.col("early.p").alias("q"))
    found = same_place.union(shorter).union(longer).where("other < id").distinct()
    # the words of both lines, each without the place that differs
    text = chosen.select("id", "h1", "h2", F.split("line", " ").alias("words"))
    other = chosen.select(F.col("id").alias("other"), F.split("line", " ").alias("others"))
    pair = found.join(text, "id").join(other, "other")
    without = lambda words, p: F.when(F.col(p) < 0, F.col(words)).otherwise(
        F.concat(F.slice(words, F.lit(1), F.greatest(F.col(p), F.lit(0))), F.slice(words, F.col(p) + 2, F.size(words)))
    )
    return pair.where(without("words", "p") == without("others", "q")).select("h1", "h2").distinct()


def dropped_lines(docs, doc_id="doc_id", text="text", near_words=NEAR_WORDS):
    """``row`` (a hash of id and text), ``equal`` and ``near``: numbers of the lines that go."""
    rows = docs.select(F.xxhash64(doc_id, text).alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    slim = _slim(rows, near_words)
    near = _near(rows, slim).withColumn("near", F.lit(True))
    place = F.struct("doc_id", "row", "no")
    lines = slim.select("row", "doc_id", "no", "h1", "h2")
    known = lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("many"))
    known = staged(known.join(near, ["h1", "h2"], "left").where("many > 1 OR near").drop("many"), "known")
    bad = _only(lines, known, ["h1", "h2"]).where((place != F.col("first")) | F.col("near"))
    bad = bad.withColumn("is_near", F.coalesce("near", F.lit(False)) & (place == F.col("first")))
    return bad.groupBy("row").agg(
        F.collect_set(F.when(~F.col("is_near"), F.col("no"))).alias("equal"), F.collect_set(F.when(F.col("is_near"), F.col("no"))).alias("near")
    )


def dedup_lines(docs, doc_id="doc_id", text="text", near_words=NEAR_WORDS):
    """``docs`` with the text's lines that stay, and ``n_lines``, ``n_equal``, ``n_near``."""
    counts = ["n_lines", "n_equal", "n_near"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in counts])
    gone = dropped_lines(docs, doc_id, text, near_words)
    gone = gone.select(F.col("row").alias("_row"), F.col("equal").alias("_equal"), F.col("near").alias("_near"))
    rows = packed(docs, F.xxhash64(doc_id, text).alias("_row")).join(gone, "_row", "left")
    whole = F.col("_doc")[text]
    lines = F.split(whole, "\n")
    all_gone = F.concat("_equal", "_near")
    kept = F.array_join(F.filter(lines, lambda line, no: ~F.array_contains(F.col("_gone"), no)), "\n")
    out = rows.withColumn("_gone", all_gone).withColumns(
        {
            "n_lines": F.when(whole.isNull(), 0).otherwise(F.size(lines)).cast("long"),
            "n_equal": F.coalesce(F.size("_equal"), F.lit(0)).cast("long"),
            "n_near": F.coalesce(F.size("_near"), F.lit(0)).cast("long"),
            "_text": F.when(F.col("_gone").isNull(), whole).otherwise(kept),
        }
    )
    return out.select(*[F.col("_text").alias(c) if c == text else F.col("_doc")[c].alias(c) for c in docs.columns], *counts)


SQL = rf"""
WITH l AS (SELECT doc_id, i AS no, trim(regexp_replace(string_split(text, chr(10))[i], '{BLANKS}', ' ', 'g')) AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
f AS (SELECT line, min((doc_id, no)) AS spot FROM l WHERE line <> '' GROUP BY line),
w AS (SELECT line, spot, string_split(line, ' ') AS w FROM f WHERE len(string_split(line, ' ')) >= {NEAR_WORDS}),
v AS (SELECT line, spot, p, array_to_string(list_concat(w[:p - 1], w[p + 1:]), ' ') AS v
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS p FROM w)),
n AS (
  SELECT v.line FROM v JOIN (SELECT v, p, min(spot) AS lead0 FROM v GROUP BY v, p) g ON v.v = g.v AND v.p = g.p WHERE lead0 < spot
  UNION SELECT v.line FROM v JOIN w ON v.v = w.line WHERE w.spot < v.spot
  UNION SELECT w.line FROM w JOIN (SELECT v, min(spot) AS lead0 FROM v GROUP BY v) g ON g.v = w.line WHERE lead0 < w.spot),
m AS (SELECT l.doc_id, l.no, string_split(d.text, chr(10))[l.no] AS raw,
    l.line <> '' AND (l.doc_id, l.no) <> f.spot AS equal,
    l.line <> '' AND (l.doc_id, l.no) = f.spot AND n.line IS NOT NULL AS near
  FROM l JOIN documents d USING (doc_id) LEFT JOIN f ON f.line = l.line LEFT JOIN n ON n.line = l.line)
SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY no) FILTER (NOT coalesce(equal, false) AND NOT coalesce(near, false)), '') AS text,
  count(*) AS n_lines, count(*) FILTER (equal) AS n_equal, count(*) FILTER (near) AS n_near
FROM m GROUP BY doc_id
UNION ALL SELECT doc_id, NULL, 0, 0, 0 FROM documents WHERE text IS NULL
"""


@register("op1_line_dedup", SQL)
def op1_line_dedup(spark, folder):
    return dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
