"""Lines that recur across documents up to variable fields, found by a log-template tree.

The tree has a fixed depth: a line goes by its number of tokens, then by its first
``DEPTH`` tokens, to a leaf; the tree ends earlier for a line of fewer tokens, whose leaf
has that one form. Tokens with a digit are variable fields from the start. In a
leaf with several forms, a place where most forms agree on a token keeps it and any other
place becomes a variable field, as long as ``CONSTANT`` of the places keep theirs; the
forms that agree in those places are one template, every other form is its own. A line
is dropped if a document with a smaller identifier has a line of the same template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_and_text, join_by_share, let
from corpusloom.sources.tables import spread
from corpusloom.workspace import materialize

DEPTH = 3
CONSTANT = 0.8
FIELD = "<*>"
FROM_DIGIT = r"[0-9][^\x20\x09-\x0D]*+"
# What a text holds if any of its lines is to be written otherwise.
UNEVEN = r"[0-9\t\x0b\x0c\r]| {2}"
MAX_BROADCAST = 500_000
# A form is compared by two independent hashes.
KEY = {"a": "xxhash64(form)", "b": "xxhash64(1, form)"}


def lines(docs: DataFrame, depth: int) -> DataFrame:
    """``(doc_id, line, form, tokens, leaf)`` of all lines but blank ones; ``form`` has one blank between tokens and a field for each with a digit."""
    text = F.col("text")
    # Both ways from a digit to the end of its token. One pattern for the whole token would
    # try every place of every word.
    headless = F.reverse(F.regexp_replace(F.reverse(text), FROM_DIGIT, "0"))
    fields = F.regexp_replace(headless, FROM_DIGIT, FIELD)
    fielded = F.when(text.rlike("[0-9]"), fields).otherwise(text)
    plain = fielded
    for blank in "\t\x0b\x0c\r":  # a search for bytes, where translate looks up each character
        plain = F.replace(plain, F.lit(blank), F.lit(" "))

    def single(blanks: Column) -> Column:
        return F.when(
            F.contains(blanks, F.lit("  ")), F.regexp_replace(blanks, " {2,}", " ")
        ).otherwise(blanks)

    even = F.when(text.rlike(UNEVEN), let(plain, single)).otherwise(text)
    # a step of its own, so that it is computed once
    stepped = docs.select("doc_id", even.alias("text"))
    split = stepped.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "value"))
    form = F.trim("value")
    formed = split.select("doc_id", "line", form.alias("form")).withColumn(
        "tokens", F.length("form") - F.length(F.replace("form", F.lit(" "), F.lit(""))) + 1
    )
    # of a line with at most so many tokens that is all of it
    leaf = F.xxhash64("tokens", F.substring_index("form", " ", depth))
    return formed.filter("form != ''").withColumn("leaf", leaf)


def templates(forms: DataFrame, found: DataFrame, constant: float) -> DataFrame:
    """``(a, b, first_doc, n)`` with the first document of the template of each form
    that recurs, ``n`` the lines of the form.

    ``forms`` has the forms by hash, ``found`` the written lines they come from, whose
    tokens are looked at only in leaves with more than one form.
    """
    crowded = forms.groupBy("leaf").agg(F.count("*").alias("forms")).filter("forms > 1")
    crowded = materialize(crowded, "leaves")
    if crowded.count() <= MAX_BROADCAST:  # 16 bytes each; beyond that the join shuffles
        crowded = F.broadcast(crowded)
    spelled = found.join(crowded, "leaf").groupBy("form", "leaf", "forms").agg(F.lit(1).alias("x"))
    key = [F.expr(hashed).alias(name) for name, hashed in KEY.items()]
    # written with the hashes of its tokens, which would be split again for each otherwise
    tokens = F.transform(F.split("form", " "), lambda t: F.xxhash64(t)).alias("tokens")
    spelled = spread(materialize(spelled.select(tokens, "leaf", "forms", *key), "forms"))

    each = spelled.select(
        "leaf", "forms", F.size("tokens").alias("size"), F.posexplode("tokens").alias("place", "token")
    )
    counted = each.groupBy("leaf", "forms", "size", "place", "token").agg(F.count("*").alias("n"))
    # more than half of the forms of a leaf agree on at most one token of a place
    agreed = counted.filter(2 * F.col("n") > F.col("forms"))
    kept = agreed.groupBy("leaf", "size").agg(
        F.sort_array(F.collect_list(F.struct("place", "token"))).alias("kept")
    )
    general = kept.filter(F.size("kept") >= constant * F.col("size"))
    general = materialize(general.select("leaf", "kept"), "templates")

    agrees = F.forall("kept", lambda k: F.get("tokens", k["place"]) == k["token"])
    fitting = spelled.join(general, "leaf").filter(agrees).select("a", "b", F.lit(True).alias("fits"))
    shaped = materialize(forms.join(fitting, ["a", "b"], "left"), "shaped")
    together = (
        shaped.filter("fits")
        .groupBy("leaf")
        .agg(F.min("first_doc").alias("first"), F.max("last_doc").alias("last"))
    )
    joined = shaped.filter("fits").join(together, "leaf")
    joined = joined.select("a", "b", F.col("first").alias("first_doc"), F.col("last").alias("last_doc"), "n")
    alone = shaped.filter("fits is null").select("a", "b", "first_doc", "last_doc", "n")
    return alone.unionByName(joined).filter("first_doc < last_doc").select("a", "b", "first_doc", "n")


def line_dedup(docs: DataFrame, depth: int = DEPTH, constant: float = CONSTANT) -> DataFrame:
    """``(doc_id, text, n_lines, n_dropped)`` of each row, ``text`` without the dropped
    lines.

    Lines are what stands between line feeds. Blank lines stay. A null text is ''. Rows without an identifier stay
    whole; rows that repeat one are one document, whose lines never count against each
    other. An empty table gives no rows.
    """
    rows = id_and_text(docs)
    found = lines(rows.filter("doc_id is not null"), depth)
    key = [F.expr(hashed).alias(name) for name, hashed in KEY.items()]
    # written with its forms: the texts are taken apart only once
    found = materialize(found.select("doc_id", "line", "leaf", "form", *key), "lines")
    placed = found.select("doc_id", "line", "leaf", *KEY)
    forms = placed.groupBy("a", "b", "leaf").agg(
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
        F.count("*").alias("n"),
    )
    forms = materialize(forms, "form-counts")
    recurring = materialize(templates(forms, found, constant), "recurring")
    met = join_by_share(placed, recurring, ["a", "b"], "n", placed.count())
    dropped = (
        met.filter("first_doc < doc_id")
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_set("line")).alias("dropped"))
    )
    joined = rows.join(dropped, "doc_id", "left")

    def without(split: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(split) - 1)
        kept = F.transform(F.array_except(places, F.col("dropped")), lambda i: F.get(split, i))
        return F.array_join(kept, "\n")

    whole = F.col("dropped").isNull()
    text = F.when(whole, F.col("text")).otherwise(let(F.split("text", "\n"), without))
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return joined.select(
        "doc_id",
        text.alias("text"),
        (breaks + 1).cast("bigint").alias("n_lines"),
        F.when(whole, 0).otherwise(F.size("dropped")).cast("bigint").alias("n_dropped"),
    )
