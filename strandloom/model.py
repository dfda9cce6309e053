"""Triples: (subject, predicate, object), three strings that are never null.

URIs are bare, blank nodes are `_:label`, literals are their lexical text.  A triple whose object is a
node is an edge; one whose object is neither a node nor looks like a URI is a fact.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
PROV = "http://www.w3.org/ns/prov#"
XSD = "http://www.w3.org/2001/XMLSchema#"

TYPE, LABEL, COMMENT, DEFINED_BY = RDF + "type", RDFS + "label", RDFS + "comment", RDFS + "isDefinedBy"
SUBCLASS, SUBPROPERTY, DOMAIN, RANGE = RDFS + "subClassOf", RDFS + "subPropertyOf", RDFS + "domain", RDFS + "range"
IMPORTS, SAME_AS = OWL + "imports", OWL + "sameAs"
PREF_LABEL = SKOS + "prefLabel"
OBSERVED_DATATYPE = PROV + "observedLiteralDatatype"
#: Predicates that describe rather than relate; they never make edges.
NOT_EDGES = [TYPE, LABEL, COMMENT, DEFINED_BY, IMPORTS]
#: Classes of these vocabularies describe the schema; nodes are never typed by them.
META_NAMESPACES = [RDF, RDFS, OWL, SKOS]

SPO = ["subject", "predicate", "object"]
TRIPLES = T.StructType([T.StructField(c, T.StringType(), False) for c in SPO])
URI_SHAPE = r"^(https?://|_:)"


def looks_like_uri(c: Column) -> Column:
    return c.rlike(URI_SHAPE)


def as_triples(df: DataFrame, subject: Column | str, predicate: Column | str, obj: Column | str) -> DataFrame:
    """Three columns as triples; a predicate given as text is a constant."""
    p = F.lit(predicate) if isinstance(predicate, str) else predicate
    col = lambda x: F.col(x) if isinstance(x, str) else x
    return df.select(col(subject).alias("subject"), p.alias("predicate"), col(obj).alias("object"))


def property_of(triples: DataFrame, predicate: str, name: str) -> DataFrame:
    """(subject, name) for one predicate."""
    return triples.where(F.col("predicate") == predicate).select("subject", F.col("object").alias(name))


def entities_of(triples: DataFrame, kind: str) -> DataFrame:
    """The distinct subjects of a type."""
    return triples.where((F.col("predicate") == TYPE) & (F.col("object") == kind)).select("subject").distinct()


def properties_of(triples: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row per subject with a column for each of several single-valued predicates: one aggregate, no joins."""
    some = triples.where(F.col("predicate").isin(list(names)))
    return some.groupBy("subject").agg(*[F.max(F.when(F.col("predicate") == p, F.col("object"))).alias(n) for p, n in names.items()])


def star_properties(entities: DataFrame, triples: DataFrame, names: dict[str, str]) -> DataFrame:
    """entities (subject) with each property joined on: values of multi-valued predicates multiply."""
    for predicate, name in names.items():
        entities = entities.join(property_of(triples, predicate, name), "subject", "left")
    return entities


def starts_with_any(c: Column, prefixes: list[str]) -> Column:
    return functools.reduce(operator.or_, [c.startswith(p) for p in prefixes], F.lit(False))


def detect(c: Column, prefixes: dict[str, list[str]]) -> Column:
    """The first name one of whose prefixes a URI starts with, else null."""
    out = F.lit(None).cast("string")
    for name, some in reversed(prefixes.items()):
        out = F.when(starts_with_any(c, some), F.lit(name)).otherwise(out)
    return out


def gated(triples: DataFrame, predicates: list[str]) -> DataFrame:
    """Only these predicates, once each: what a chain of joins over possibly restated facts must start from."""
    return triples.where(F.col("predicate").isin(predicates)).dropDuplicates(SPO)


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def number_of(literal: Column) -> Column:
    """The text before `^^` as a finite double, else null."""
    parsed = F.split(literal, r"\^\^").getItem(0).try_cast("double")
    return F.when(is_finite(parsed), parsed)


def added(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct new triples that do not exist yet."""
    return new.select(*SPO).distinct().join(existing.select(*SPO), SPO, "left_anti")


def merged(frames: list[DataFrame]) -> DataFrame:
    """Set union."""
    return functools.reduce(DataFrame.unionByName, [f.select(*SPO) for f in frames]).dropDuplicates(SPO)


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """Bag union."""
    return functools.reduce(DataFrame.unionByName, frames)
