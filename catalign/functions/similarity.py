"""Similarity of codes, texts and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalign.functions import fixed
from catalign.functions.blocks import block_ratio  # noqa: F401


def letters(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.upper(text), ""), lambda c: c != ""))


def jaccard(left: Column, right: Column) -> Column:
    """Shared over joint members of two sets; 0 when both are empty."""
    joint = F.size(F.array_union(left, right))
    shared = F.size(F.array_intersect(left, right))
    return F.when(joint > 0, shared / joint).otherwise(F.lit(0.0))


def letter_similarity(left: Column, right: Column) -> Column:
    empty = (F.coalesce(left, F.lit("")) == "") | (F.coalesce(right, F.lit("")) == "")
    return F.when(empty, F.lit(0.0)).otherwise(jaccard(letters(left), letters(right)))


def words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(F.trim(text)), r"\s+"), lambda w: w != ""))


def word_parts(text: Column) -> Column:
    """What ``word_similarity`` compares of a text: the text without outer blanks in lower case, and its distinct words."""
    return F.struct((F.coalesce(text, F.lit("")) == "").alias("empty"), F.lower(F.trim(text)).alias("text"), words(text).alias("words"))


def _part_similarity(left: Column, right: Column) -> Column:
    a, b = left["words"], right["words"]
    shared = F.size(F.array_intersect(a, b))
    return (F.when(left["empty"] | right["empty"], 0.0).when(left["text"] == right["text"], 1.0)
            .when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(shared / (F.size(a) + F.size(b) - shared)))


def word_similarity(left: Column, right: Column) -> Column:
    """Word-set overlap; equal texts score 1, empty ones 0."""
    return _part_similarity(word_parts(left), word_parts(right))


# a search over many names takes the parts of each text and name once and compares those
word_similarity.parts, word_similarity.compare = word_parts, _part_similarity


def domain_boost(left: Column, right: Column) -> Column:
    """Bonus for family, engine and package words found in both texts, capped."""
    a, b = F.lower(left), F.lower(right)
    total = F.lit(0.0)
    for weight, group in fixed.BOOST_WORDS:
        for word in group:
            total = total + F.when(a.contains(word) & b.contains(word), F.lit(weight)).otherwise(F.lit(0.0))
    return F.least(F.lit(fixed.BOOST_CAP), total)


def combined_confidence(similarity: Column, exact: Column, boost: Column) -> Column:
    return F.least(F.lit(1.0), similarity + exact * 0.1 + F.least(boost, F.lit(fixed.BOOST_CAP)))


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(left: Column, right: Column) -> Column:
    norms = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.when(norms > 0, dot(left, right) / norms).otherwise(F.lit(0.0))
