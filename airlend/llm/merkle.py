"""Document fingerprints: Merkle trees over sections, paragraphs and pieces of up to eight words.

Sections are parted by an empty line, paragraphs by a line break; pieces tile a paragraph. A piece's digest is
the MD5 of its text, a paragraph's that of its pieces' digests, a section's that of its paragraphs', and the root
is the SHA-256 of the sections' digests. Equal roots mean equal texts; where roots differ, `differing` follows
the branches down to the paragraphs that were edited. The fingerprint string is the root, a colon and the
first eight hex digits of every piece's digest, so likeness can be told from two fingerprints alone.

Everything is expressed in DataFrame functions. A null text is empty: no pieces. Of equally many pieces nothing
is left out, so a fingerprint grows with its text (by about a seventh).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlend.llm.common import dense_order, keyed, stage

PIECE_WORDS = 8
SHOWN_DIGITS = 8
_S, _W = r"[ \t\r\f\x0B]", r"[^ \t\r\f\x0B]"
_PIECE = rf"{_S}*(?:{_W}+{_S}*){{1,{PIECE_WORDS}}}|{_S}+"


def _md5(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def tree(text: Column) -> Column:
    """Array of sections: (digest, paragraphs: array of (digest, pieces: array of digests))."""

    def paragraph(line: Column) -> Column:
        pieces = F.transform(F.regexp_extract_all(line, F.lit(_PIECE), F.lit(0)), _md5)
        return F.struct(pieces.alias("pieces"))

    def with_digest(p: Column) -> Column:
        return F.struct(_md5(F.array_join(p["pieces"], "")).alias("digest"), p["pieces"].alias("pieces"))

    def section(part: Column) -> Column:
        return F.struct(F.transform(F.transform(F.split(part, "\n"), paragraph), with_digest).alias("paragraphs"))

    def section_digest(s: Column) -> Column:
        digests = F.transform(s["paragraphs"], lambda p: p["digest"])
        return F.struct(_md5(F.array_join(digests, "")).alias("digest"), s["paragraphs"].alias("paragraphs"))

    return F.transform(F.transform(F.split(text, "\n\n"), section), section_digest)


def root(sections: Column) -> Column:
    return F.sha2(F.array_join(F.transform(sections, lambda s: s["digest"]), ""), 256)


def pieces(sections: Column) -> Column:
    """The short digests of all pieces, in order."""
    paragraphs = F.flatten(F.transform(sections, lambda s: s["paragraphs"]))
    digests = F.flatten(F.transform(paragraphs, lambda p: p["pieces"]))
    return F.transform(digests, lambda d: F.substring(d, 1, SHOWN_DIGITS))


def likeness(left: Column, right: Column) -> Column:
    """Of two arrays of pieces: twice the common ones over all, each counted once; 1 if both are empty."""
    left, right = F.array_distinct(left), F.array_distinct(right)
    size = F.size(left) + F.size(right)
    return F.when(size == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(left, right)) / size)


def differing(left: Column, right: Column) -> Column:
    """Places (section, paragraph) of paragraphs in the tree `left` that the tree `right` has nowhere.

    Sections that `right` has as a whole are not descended into.
    """
    sections = F.transform(right, lambda s: s["digest"])
    paragraphs = F.flatten(F.transform(right, lambda s: F.transform(s["paragraphs"], lambda p: p["digest"])))
    numbered = F.transform(
        left,
        lambda s, i: F.when(
            ~F.array_contains(sections, s["digest"]),
            F.filter(
                F.transform(
                    s["paragraphs"],
                    lambda p, j: F.when(
                        ~F.array_contains(paragraphs, p["digest"]), F.struct(i.alias("section"), j.alias("paragraph"))
                    ),
                ),
                lambda place: place.isNotNull(),
            ),
        ),
    )
    return F.flatten(F.filter(numbered, lambda places: places.isNotNull()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, tree, root and fingerprint of all documents; other columns are not read."""
    rows = keyed(docs).select("doc_id", "text").withColumn("tree", tree(F.col("text")))
    rows = rows.withColumn("root", root(F.col("tree")))
    return rows.withColumn("fingerprint", F.concat_ws(":", "root", F.array_join(pieces(F.col("tree")), "")))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document beside its successor in doc_id order and an edited text that ends with the successor's begin.

    The last n_chars // 4 code points are replaced by the first as many (or all) of the next document; the
    first document follows the last. Documents of one doc_id follow each other in the order of a hash of their
    text; rows that repeat both are one document, and each gets its result. A null doc_id comes first.

    doc_id, n_chars, edited (text), fingerprint, edited_fingerprint, near_edited, near_next.
    """
    texts = keyed(docs).select("dk", "th", "text")
    keys = stage(texts.select("dk", "th", F.length("text").alias("n")).distinct(), "keys")
    ordered = stage(dense_order(keys, "dk", "th"), "order")
    total = ordered.count()
    after = ordered.select(((F.col("pos") - 1 + total) % max(total, 1)).alias("pos"), "dk", "th")
    own = [F.col("dk").alias("own_dk"), F.col("th").alias("own_th"), F.floor(F.col("n") / 4).cast("int").alias("cut")]
    pairs = ordered.select("pos", *own).join(after, "pos")
    # One exchange of the texts by key serves this join and the last one: both read the same columns by the same names.
    nexts = pairs.join(texts, ["dk", "th"]).select(
        F.col("own_dk").alias("dk"),
        F.col("own_th").alias("th"),
        "cut",
        F.expr("substring(text, 1, cut)").alias("begin"),
        pieces(tree(F.col("text"))).alias("next_pieces"),
    )
    nexts = nexts.groupBy("dk", "th").agg(*[F.first(c).alias(c) for c in ("cut", "begin", "next_pieces")])
    rows = texts.join(nexts, ["dk", "th"])
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - cut)"), "begin"))
    for name, text in (("own", "text"), ("new", "edited")):
        rows = rows.withColumn(f"{name}_tree", tree(F.col(text)))
        rows = rows.withColumn(f"{name}_root", root(F.col(f"{name}_tree")))
        rows = rows.withColumn(f"{name}_pieces", pieces(F.col(f"{name}_tree"))).drop(f"{name}_tree")
    return rows.select(
        F.when(F.col("dk") != -(2**63), F.col("dk")).alias("doc_id"),
        "n_chars",
        "edited",
        F.concat_ws(":", "own_root", F.array_join("own_pieces", "")).alias("fingerprint"),
        F.concat_ws(":", "new_root", F.array_join("new_pieces", "")).alias("edited_fingerprint"),
        likeness(F.col("own_pieces"), F.col("new_pieces")).alias("near_edited"),
        likeness(F.col("own_pieces"), F.col("next_pieces")).alias("near_next"),
    )
