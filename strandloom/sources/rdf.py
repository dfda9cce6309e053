"""N-Triples as SQL expressions, Turtle documents as a small parser behind mapInArrow."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import OBSERVED_DATATYPE, RDF, TYPE, XSD
from ..workers import ship

#: Columns that Turtle documents come in, first that exists.
BLOB_COLUMNS = ["triples", "rdf_turtle"]


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """Triples of N-Triples files. Anchored: a line is subject, predicate, object and a dot; comments, blank and other lines are left out.

    Subjects and objects may be blank nodes. Literals are their quoted body with escapes as written.
    """
    line = r'^\s*(?:<([^>]*)>|(_:\S+))\s+<([^>]*)>\s+(?:<([^>]*)>|(_:\S+)|"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>|@[A-Za-z0-9-]+)?)\s*\.\s*(?:#.*)?$'
    rows = spark.read.text(path).where(F.col("value").rlike(line))
    part = lambda i: F.regexp_extract("value", line, i)
    first = lambda *i: F.coalesce(*[F.when(part(x) != "", part(x)) for x in i], F.lit(""))
    return rows.select(first(1, 2).alias("subject"), part(3).alias("predicate"), first(4, 5, 6).alias("object"), part(7).alias("object_datatype")).where("subject <> '' AND predicate <> ''")


def write_ntriples(triples: DataFrame, path: str) -> None:
    """One statement a line; an object that does not look like a URI is a plain literal."""
    term = lambda c: F.when(F.col(c).startswith("_:"), F.col(c)).otherwise(F.concat(F.lit("<"), F.col(c), F.lit(">")))
    quoted = F.regexp_replace(F.regexp_replace(F.regexp_replace("object", r"\\", r"\\\\"), '"', r'\\"'), "\n", r"\\n")
    obj = F.when(F.col("object").rlike(r"^(https?://|_:)"), term("object")).otherwise(F.concat(F.lit('"'), quoted, F.lit('"')))
    triples.select(F.concat_ws(" ", term("subject"), term("predicate"), obj, F.lit("."))).write.mode("overwrite").text(path)


class TurtleError(ValueError):
    pass


_TOKEN = re.compile(
    r'\s+|#[^\n]*|(?P<long>"""(?:[^"\\]|\\.|"(?!""))*"""|\'\'\'(?:[^\'\\]|\\.|\'(?!\'\'))*\'\'\')|(?P<string>"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\')'
    r"|(?P<iri><[^<>\"{}|^`\\\x00-\x20]*>)|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<type>\^\^)|(?P<blank>_:[\w][\w.-]*(?<!\.))"
    r"|(?P<number>[+-]?(?:\d+\.\d*[eE][+-]?\d+|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+))|(?P<name>(?:[A-Za-z_][\w-]*(?:\.[\w-]+)*)?:(?:[\w:%-]|\\.|\.(?=[\w:%-]))*)"
    r"|(?P<word>[A-Za-z]+)|(?P<mark>[.;,\[\]()])",
    re.DOTALL,
)
_ESCAPES = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def _unescaped(s: str) -> str:
    def one(m: re.Match) -> str:
        x = m[1]
        return chr(int(x[1:], 16)) if x[0] in "uU" else _ESCAPES.get(x, x)

    return re.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", one, s, flags=re.DOTALL) if "\\" in s else s


def _parse_date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


#: How typed literals are spelled: by the value's Python text, where the lexical form can be read; otherwise as written.
_SPELLED: dict[str, Callable[[str], object]] = {
    **{XSD + t: int for t in ("integer", "int", "long", "short", "byte", "nonNegativeInteger", "positiveInteger", "negativeInteger", "nonPositiveInteger", "unsignedInt", "unsignedLong", "unsignedShort", "unsignedByte")},
    XSD + "decimal": decimal.Decimal,
    XSD + "double": float,
    XSD + "float": float,
    XSD + "boolean": lambda s: {"true": True, "1": True, "false": False, "0": False}[s.strip().lower()],
    XSD + "date": _parse_date,
    XSD + "dateTime": dt.datetime.fromisoformat,
    XSD + "time": dt.time.fromisoformat,
}


def spelled(value: str, datatype: str) -> str:
    if convert := _SPELLED.get(datatype):
        try:
            return str(convert(value))
        except (ValueError, KeyError, ArithmeticError):
            return value
    return value


class _Turtle:
    """A recursive-descent reader of the Turtle that data is written in: prefixes, base, `a`, `;`, `,`, `[]`, lists, literals."""

    def __init__(self, text: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TurtleError(f"unexpected text at {at}: {text[at : at + 20]!r}")
            if m.lastgroup:
                self.tokens.append((m.lastgroup, m[0]))
            at = m.end()
        self.at, self.blanks, self.base = 0, 0, ""
        self.prefixes: dict[str, str] = {}
        self.rows: list[tuple[str, str, str, str]] = []

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, value: str | None = None) -> tuple[str, str]:
        t = self.peek()
        if t[0] == "end" or value is not None and t[1] != value:
            raise TurtleError(f"expected {value or 'a term'}, found {t[1] or 'the end'}")
        self.at += 1
        return t

    def fresh(self) -> str:
        self.blanks += 1
        return f"_:anon{self.blanks}"

    def document(self) -> list[tuple[str, str, str, str]]:
        while self.peek()[0] != "end":
            kind, value = self.peek()
            if (kind, value.lower()) in (("lang", "@prefix"), ("lang", "@base"), ("word", "prefix"), ("word", "base")):
                self.directive(value.lower().lstrip("@"), kind == "lang")
            else:
                if value == "[":
                    subject = self.anonymous()
                    if self.peek()[1] != ".":
                        self.properties(subject)
                else:
                    subject = self.term()[0]
                    self.properties(subject)
                self.take(".")
        return self.rows

    def directive(self, what: str, dotted: bool) -> None:
        self.take()
        if what == "prefix":
            kind, name = self.take()
            if kind != "name" or not name.endswith(":"):
                raise TurtleError(f"{name} is no prefix")
            self.prefixes[name[:-1]] = self.iri(self.take()[1])
        else:
            self.base = self.iri(self.take()[1])
        if dotted:
            self.take(".")

    def iri(self, token: str) -> str:
        inner = _unescaped(token[1:-1])
        return inner if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", inner) else self.base + inner

    def properties(self, subject: str) -> None:
        while True:
            kind, value = self.peek()
            if kind == "word" and value == "a":
                self.take()
                predicate = TYPE
            else:
                predicate = self.term()[0]
            while True:
                obj, datatype = self.term()
                self.rows.append((subject, predicate, obj, datatype))
                if self.peek()[1] != ",":
                    break
                self.take()
            if self.peek()[1] != ";":
                return
            while self.peek()[1] == ";":
                self.take()
            if self.peek()[1] in (".", "]"):
                return

    def anonymous(self) -> str:
        self.take("[")
        node = self.fresh()
        if self.peek()[1] != "]":
            self.properties(node)
        self.take("]")
        return node

    def listed(self) -> str:
        self.take("(")
        head = last = RDF + "nil"
        while self.peek()[1] != ")":
            node, (item, datatype) = self.fresh(), self.term()
            self.rows.append((node, RDF + "first", item, datatype))
            if head == RDF + "nil":
                head = node
            else:
                self.rows.append((last, RDF + "rest", node, ""))
            last = node
        self.take(")")
        if head != RDF + "nil":
            self.rows.append((last, RDF + "rest", RDF + "nil", ""))
        return head

    def term(self) -> tuple[str, str]:
        kind, value = self.peek()
        if value == "[":
            return self.anonymous(), ""
        if value == "(":
            return self.listed(), ""
        self.take()
        if kind == "iri":
            return self.iri(value), ""
        if kind == "blank":
            return value, ""
        if kind == "name":
            prefix, _, local = value.partition(":")
            if prefix not in self.prefixes:
                raise TurtleError(f"prefix {prefix}: is not declared")
            return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local), ""
        if kind == "number":
            datatype = XSD + ("double" if "e" in value.lower() else "decimal" if "." in value else "integer")
            return spelled(value, datatype), datatype
        if kind == "word" and value in ("true", "false"):
            return spelled(value, XSD + "boolean"), XSD + "boolean"
        if kind in ("string", "long"):
            body = _unescaped(value[3:-3] if kind == "long" else value[1:-1])
            if self.peek()[0] == "lang":
                self.take()
                return body, ""
            if self.peek()[0] == "type":
                self.take()
                datatype = self.term()[0]
                return spelled(body, datatype), datatype
            return body, XSD + "string"
        raise TurtleError(f"{value!r} is no term")


def blank_labels(rows: list[tuple[str, str, str, str]]) -> dict[str, str]:
    """A label for each blank node made from what is said about it, so that one document gives the same rows every time.

    Partition refinement: all blank nodes begin in one class; nodes stay together while their facts, with classes in place of blank neighbours,
    are equal.  It ends when no class splits, so nodes that no facts tell apart are the only ones that share a class; they are numbered.
    """
    facts: dict[str, list[tuple[str, bool, str]]] = {}
    for s, p, o, _ in rows:
        for node, other, forward in ((s, o, True), (o, s, False)):
            if node.startswith("_:"):
                facts.setdefault(node, []).append((p, forward, other))
    digest = dict.fromkeys(facts, "")
    classes = 0
    while classes < (found := len(set(digest.values()))):
        classes = found
        seen = {n: sorted((p, forward, digest.get(x, x), x in digest) for p, forward, x in own) for n, own in facts.items()}
        digest = {n: hashlib.sha256(repr((digest[n], own)).encode()).hexdigest() for n, own in seen.items()}
    order: Counter[str] = Counter()
    labels = {}
    for node, code in digest.items():
        labels[node] = f"_:b{code[:24]}" + (f"n{order[code]}" if order[code] else "")
        order[code] += 1
    return labels


def turtle_rows(text: str) -> list[tuple[str, str, str, str]]:
    """Distinct (subject, predicate, object, object_datatype) of one document; raises TurtleError for a malformed one."""
    rows = _Turtle(text).document()
    labels = blank_labels(rows)
    return list(dict.fromkeys((labels.get(s, s), p, labels.get(o, o), d) for s, p, o, d in rows))


def rows_or_nothing(text: str) -> list[tuple[str, str, str, str]]:
    """A malformed document has no rows."""
    try:
        return turtle_rows(text)
    except TurtleError:
        return []


def blob_column(columns: list[str], name: str | None = None, candidates: list[str] | None = None) -> str:
    """The named column, which must exist, else the first candidate that does."""
    options = [name] if name else candidates or BLOB_COLUMNS
    if found := [c for c in options if c in columns]:
        return found[0]
    raise ValueError(f"none of {options} is a column; there are {columns}")


PARSED = "subject string, predicate string, object string, object_datatype string"


def parse_turtle(documents: DataFrame, column: str) -> DataFrame:
    """Parsed triples of a column of Turtle documents; null and blank ones are left out.

    Each document is parsed whole, on the executors; rows leave in batches of at most spark.sql.execution.arrow.maxRecordsPerBatch.
    """
    spark = documents.sparkSession
    most = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    most = most if most > 0 else 10_000
    names = ["subject", "predicate", "object", "object_datatype"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, str, str, str]] = []

        def out(rows: list[tuple[str, str, str, str]]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names)

        for b in batches:
            for text in b.column(0).to_pylist():
                held += rows_or_nothing(text)
                while len(held) >= most:
                    yield out(held[:most])
                    held = held[most:]
        if held:
            yield out(held)

    ship(spark)
    return documents.select(column).where(F.trim(column) != "").mapInArrow(run, PARSED)


def read_turtle(spark: SparkSession, path: str, column: str | None = None) -> DataFrame:
    """Parsed triples of Parquet files that hold one Turtle document a row."""
    rows = spark.read.parquet(path)
    return parse_turtle(rows, blob_column(rows.columns, column))


def datatype_markers(parsed: DataFrame) -> DataFrame:
    """(predicate, observed datatype) of literals as triples: what the triples themselves no longer say. A few rows, hence one file."""
    seen = parsed.where("object_datatype <> ''").select("predicate", "object_datatype").distinct()
    return seen.select(F.col("predicate").alias("subject"), F.lit(OBSERVED_DATATYPE).alias("predicate"), F.col("object_datatype").alias("object")).coalesce(1)
