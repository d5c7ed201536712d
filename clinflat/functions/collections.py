"""Typed paths through nested records.

A :class:`Path` is a Spark column together with its data type. Knowing the type lets one
step through arrays (``name.given`` of an array of names) flatten exactly one level, and
lets a comparison follow the collection rules of the record standard. Every method
returns ordinary Spark expressions inside one row, so none of them shuffles.

A missing value and an empty array mean the same thing, and nulls inside arrays do not
count as items.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cache
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflat.functions import temporal
from clinflat.functions.temporal import compare_partial

# Type names and the choice-element suffix rule of the record standard.
STRING_TYPES = (
    "string", "code", "id", "uri", "url", "canonical", "oid", "uuid", "markdown",
    "base64Binary", "xhtml",
)
INTEGER_TYPES = ("integer", "positiveInt", "unsignedInt", "integer64")
TEMPORAL_TYPES = ("date", "dateTime", "instant", "time")
# The data types that a choice element may have.
CHOICE_TYPES = (
    "base64Binary", "boolean", "canonical", "code", "date", "dateTime", "decimal", "id", "instant",
    "integer", "integer64", "markdown", "oid", "positiveInt", "string", "time", "unsignedInt", "uri",
    "url", "uuid", "Address", "Age", "Annotation", "Attachment", "CodeableConcept",
    "CodeableReference", "Coding", "ContactPoint", "Count", "Distance", "Duration", "HumanName",
    "Identifier", "Money", "Period", "Quantity", "Range", "Ratio", "RatioRange", "Reference",
    "SampledData", "Signature", "Timing", "ContactDetail", "DataRequirement", "Expression",
    "ParameterDefinition", "RelatedArtifact", "TriggerDefinition", "UsageContext", "Availability",
    "ExtendedContactDetail", "Dosage", "Meta",
)


class PathError(ValueError):
    """A path that cannot be built from the declared schema."""


def value_of(x: Any) -> Column:
    if isinstance(x, Path):
        return x.col
    return x if isinstance(x, Column) else F.lit(x)


def drop_nulls(a: Column) -> Column:
    return F.array_compact(a)


def first_present(a: Column) -> Column:
    """First non-null item. The compacting branch only runs when the first item is null."""
    return F.coalesce(F.get(a, F.lit(0)), F.get(drop_nulls(a), F.lit(0)))


def size_of(a: Column) -> Column:
    """Number of non-null items; zero for a missing array."""
    return F.coalesce(F.array_size(drop_nulls(a)), F.lit(0))


def strict_one(a: Column, label: str) -> Column:
    """The only item, null when there is none, an error when there are several."""
    message = F.lit(f"{label}: more than one value where a single one is expected")
    return (
        F.when(F.coalesce(F.array_size(a), F.lit(0)) <= 1, F.get(a, F.lit(0)))
        .when(size_of(a) > 1, F.raise_error(message))
        .otherwise(first_present(a))
    )


def reference_key(reference: Column, target: str | None = None) -> Column:
    """Id inside a reference such as ``Patient/12`` or an absolute address.

    Versions are stripped. Fragments, searches, bare ids and references to another type
    give null; ``urn:uuid:`` and ``urn:oid:`` give the rest only when no type is asked.
    """
    urn = reference.rlike("^urn:(uuid|oid):")
    unusable = reference.startswith("#") | reference.contains("?")
    base = F.rtrim(F.substring_index(reference, "/_history/", 1), F.lit("/"))
    key = F.substring_index(base, "/", -1)
    owner = F.substring_index(F.substring_index(base, "/", -2), "/", 1)
    usable = ~urn & ~unusable & base.contains("/")
    if target is not None:
        # ``Patient/12`` as it stands, which nearly all references are, needs none of the above
        rest = F.substr(reference, F.lit(len(target) + 2))
        plain = reference.startswith(f"{target}/") & (rest != "") & ~rest.contains("/") & ~rest.contains("?")
        return F.when(plain, rest).when(usable & (owner == target), key)
    urn_rest = F.regexp_replace(reference, "^urn:(uuid|oid):", "")
    return F.when(urn, urn_rest).when(usable, key)


#: Mark of a Variant field whose value is an array of records: the type of these as JSON text.
RECORDS = "records"


def marked_records(level: T.StructType) -> T.StructType:
    """A level of a self-nesting record whose Variant fields are marked to hold records like it."""
    return _marked(level, level.json())


def _marked(dtype: T.DataType, text: str) -> T.DataType:
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_marked(dtype.elementType, text), dtype.containsNull)
    if not isinstance(dtype, T.StructType):
        return dtype
    fields = []
    for f in dtype.fields:
        mark = {**f.metadata, RECORDS: text} if isinstance(f.dataType, T.VariantType) else f.metadata
        fields.append(T.StructField(f.name, _marked(f.dataType, text), f.nullable, mark))
    return T.StructType(fields)


@cache
def _records_of(text: str) -> T.StructType:
    return _marked(T.StructType.fromJson(json.loads(text)), text)


class Path:
    """A column and its type; arrays are collections, everything else is a single value.

    ``plain`` says that the column only reads fields, so that naming it twice in an
    expression costs nothing; ``clean`` says that an array holds no nulls.
    """

    def __init__(
        self, col: Column | None, dtype: T.DataType, plain: bool = True, clean: bool = False
    ):
        self._col = col
        self.dtype = dtype
        self.plain = plain
        self.clean = clean

    # -- shape ---------------------------------------------------------------------

    @property
    def col(self) -> Column:
        if self._col is None:
            return F.struct(*[F.col(f"`{f.name}`") for f in self.dtype.fields])
        return self._col

    @property
    def many(self) -> bool:
        return isinstance(self.dtype, T.ArrayType)

    @property
    def item_type(self) -> T.DataType:
        return self.dtype.elementType if self.many else self.dtype

    @property
    def array(self) -> Column:
        """The items as an array, without nulls, empty when there are none."""
        if self.many:
            return F.coalesce(self.compact, F.array().cast(self.dtype))
        return F.when(self.col.isNotNull(), F.array(self.col)).otherwise(
            F.array().cast(T.ArrayType(self.dtype))
        )

    @property
    def compact(self) -> Column:
        """The items without nulls; a missing array stays missing."""
        return self.col if self.clean else drop_nulls(self.col)

    def has(self, name: str) -> bool:
        return isinstance(self.item_type, T.StructType) and name in self.item_type.names

    # -- navigation ----------------------------------------------------------------

    def __getitem__(self, name: str) -> Path:
        if not self.has(name):
            variants = [t for t in CHOICE_TYPES if self.has(name + _capital(t))]
            if not variants:
                raise PathError(f"no field {name!r} in {self.item_type.simpleString()}")
            return Choice(self, name, variants)
        field = self.item_type[name]
        ftype = field.dataType
        inner = F.col(f"`{name}`") if self._col is None else self._col[name]
        if isinstance(ftype, T.VariantType) and RECORDS in field.metadata:
            records = T.ArrayType(_records_of(field.metadata[RECORDS]))
            if not self.many:
                return Path(inner.cast(records), records, False)
            each = F.transform(drop_nulls(inner), lambda v: v.cast(records))
            return Path(F.flatten(drop_nulls(each)), records, False)
        kind = field.metadata.get("comment")
        if self._col is None or not self.many:
            return _leaf(inner, ftype, kind, self.plain or self._col is None)
        if isinstance(ftype, T.ArrayType):
            return _leaf(F.flatten(drop_nulls(inner)), ftype, kind, False)
        return _leaf(inner, T.ArrayType(ftype), kind, self.plain)

    def __iter__(self):
        raise TypeError("a path is not iterable; use items in a view's for_each")

    def go(self, dotted: str) -> Path:
        """Several steps at once: ``go("name.given")``."""
        path = self
        for step in dotted.split("."):
            path = path[step]
        return path

    def of_type(self, name: str, type_name: str) -> Path:
        """Choice element: ``of_type("value", "Quantity")`` is the field valueQuantity.

        Only the declared variant counts; a plain field ``name`` that holds resources
        (such as contained ones) is filtered by its resourceType.
        """
        variant = name + _capital(type_name)
        if self.has(variant):
            return self[variant]
        return self[name].only_type(type_name)

    def only_type(self, type_name: str) -> Path:
        """Keep items of a type. A record with a resourceType must have that very type,
        one without matches any complex type, plain text never matches a date type."""
        kind = self.item_type
        if isinstance(kind, T.StructType) and type_name[0].isupper():
            if "resourceType" not in kind.names:
                return self
            return self.where(lambda x: F.coalesce(x["resourceType"].col == type_name, F.lit(True)))
        matches = (
            (type_name in STRING_TYPES and isinstance(kind, T.StringType))
            or (type_name in INTEGER_TYPES and isinstance(kind, (T.LongType, T.IntegerType)))
            or (type_name == "boolean" and isinstance(kind, T.BooleanType))
            or (type_name == "decimal" and isinstance(kind, T.NumericType))
        )
        return self if matches else Path(F.lit(None).cast(self.dtype), self.dtype)

    def is_type(self, type_name: str) -> Column:
        """Whether the single value has a type; null when there is no value."""
        return F.when(self.one().isNotNull(), self.only_type(type_name).exists())

    def extension(self, url: str) -> Path:
        return self["extension"].where(lambda x: x["url"].col == url)

    # -- collections ---------------------------------------------------------------

    def _like(self, col: Column, dtype: T.DataType, plain: bool = False, clean: bool = False) -> Path:
        """A path to some of the same items: values of a kind stay of that kind."""
        return Path(col, dtype, plain, clean)

    def where(self, condition: Callable[..., Any]) -> Path:
        """Keep items for which the condition is true. It may take (item) or (item, index)."""
        if not self.many:
            keep = F.coalesce(_truth(condition(self)), F.lit(False))
            return self._like(F.when(keep, self.col), self.dtype)
        if condition.__code__.co_argcount == 2:

            def test(x: Column, i: Column) -> Column:
                return F.coalesce(_truth(condition(self._like(x, self.item_type, True), i)), F.lit(False))

            return self._like(F.filter(self.compact, test), self.dtype, False, True)
        return self._like(
            F.filter(
                self.col,
                lambda x: x.isNotNull()
                & F.coalesce(_truth(condition(self._like(x, self.item_type, True))), F.lit(False)),
            ),
            self.dtype,
            False,
            True,
        )

    def select(self, fn: Callable[..., Path]) -> Path:
        """Flat map; ``fn`` returns a path for each item. It may take (item) or (item, index)."""
        with_index = fn.__code__.co_argcount == 2
        if not self.many:
            return fn(self, F.lit(0)) if with_index else fn(self)
        holder: dict[str, T.DataType] = {}

        def noted(out: Path | Column) -> Column:
            holder["type"] = out.dtype if isinstance(out, Path) else T.IntegerType()
            return value_of(out)

        def body(x: Column) -> Column:
            return noted(fn(self._like(x, self.item_type, True)))

        def indexed(x: Column, i: Column) -> Column:
            return noted(fn(self._like(x, self.item_type, True), i))

        mapped = F.transform(self.compact, indexed if with_index else body)
        if isinstance(holder["type"], T.ArrayType):
            return Path(F.flatten(drop_nulls(mapped)), holder["type"], False)
        return Path(mapped, T.ArrayType(holder["type"]), False)

    def first(self) -> Path:
        if not self.many:
            return self
        if self.clean or not self.plain:
            return self._like(F.get(self.compact, F.lit(0)), self.item_type)
        return self._like(first_present(self.col), self.item_type)

    def last(self) -> Path:
        if not self.many:
            return self
        return self._like(F.try_element_at(self.compact, F.lit(-1)), self.item_type)

    def at(self, index: int | Column) -> Path:
        """Zero-based item; out of range gives null."""
        if not self.many:
            return self._like(F.when(F.lit(index) == 0, self.col), self.dtype, True)
        return self._like(F.get(self.compact, F.lit(index)), self.item_type)

    def skip(self, n: int) -> Path:
        a = self.array
        if n < 0:
            raise PathError("skip needs a count of zero or more")
        rest = F.slice(a, F.lit(n + 1), F.greatest(F.array_size(a) - n, F.lit(0)))
        return self._like(rest, T.ArrayType(self.item_type), False, True)

    def tail(self) -> Path:
        return self.skip(1)

    def take(self, n: int) -> Path:
        if n < 0:
            raise PathError("take needs a count of zero or more")
        return self._like(F.slice(self.array, F.lit(1), F.lit(n)), T.ArrayType(self.item_type), False, True)

    def one(self, label: str = "single()") -> Column:
        """The only value; several values are an error when the row is computed."""
        return strict_one(self.col, label) if self.many else self.col

    def single(self, label: str = "single()") -> Path:
        return self._like(self.one(label), self.item_type)

    def count(self) -> Column:
        if self.many:
            return F.coalesce(F.array_size(self.compact), F.lit(0))
        return F.when(self.col.isNotNull(), 1).otherwise(0)

    def exists(self, condition: Callable[..., Any] | None = None) -> Column:
        path = self if condition is None else self.where(condition)
        return path.count() > 0

    def empty(self) -> Column:
        return self.count() == 0

    def all(self, condition: Callable[..., Any]) -> Column:
        """True when the condition is true for every item, also when there is none. It may take
        (item) or (item, index)."""
        if condition.__code__.co_argcount == 2:
            return self.where(condition).count() == self.count()

        def test(x: Column) -> Column:
            return F.coalesce(_truth(condition(self._like(x, self.item_type, True))), F.lit(False))

        return F.forall(self.array, test)

    def distinct(self) -> Path:
        return Path(F.array_distinct(self.array), T.ArrayType(self.item_type), False, True)

    def union(self, other: Path) -> Path:
        """Items of both without duplicates, in order."""
        return Path(F.array_union(self.array, other.array), T.ArrayType(self.item_type), False, True)

    def or_first(self, *others: Path) -> Path:
        """First value of the first path that has one."""
        values = [p.first().col for p in (self, *others)]
        return self._like(F.coalesce(*values), self.item_type)

    def joined(self, *others: Path) -> Path:
        """Items of all paths, in order, repeated ones too."""
        return self._like(F.concat(*[p.array for p in (self, *others)]), T.ArrayType(self.item_type), False, True)

    def contains_item(self, item: Any) -> Column:
        """Membership: null for a missing item, false for an empty collection."""
        v = value_of(item)
        return F.when(v.isNotNull(), F.array_contains(self.array, v))

    def join(self, separator: str = "") -> Path:
        """Items as one text; null when there are none."""
        if not self.many:
            return Path(self.col.cast("string"), T.StringType(), False)
        items = self.col
        if not isinstance(self.item_type, T.StringType):
            items = F.transform(items, lambda x: x.cast("string"))
        return Path(F.when(self.count() > 0, F.array_join(items, separator)), T.StringType(), False)

    def has_value(self) -> Column:
        if isinstance(self.item_type, T.StructType):
            return F.lit(False)
        return self.count() == 1

    def map(self, fn: Callable[[Column], Column], dtype: T.DataType) -> Path:
        """Apply a column function to each value; missing results are dropped."""
        if self.many:
            return Path(F.transform(self.col, fn), T.ArrayType(dtype), False)
        return Path(fn(self.col), dtype, False)

    def ref_key(self, target: str | None = None) -> Path:
        """Ids of references (see :func:`reference_key`)."""
        return self["reference"].map(lambda r: reference_key(r, target), T.StringType())

    def low_boundary(self, kind: str | None = None) -> Path:
        """Earliest or smallest value that each written value can stand for. ``kind`` is date,
        dateTime, time or decimal, by default that of the field."""
        return self._boundary(temporal.low_boundary, kind)

    def high_boundary(self, kind: str | None = None) -> Path:
        """Latest or largest value that each written value can stand for."""
        return self._boundary(temporal.high_boundary, kind)

    def _boundary(self, side: Callable[[Column, str], Column], kind: str | None) -> Path:
        if not isinstance(self.item_type, T.StringType) or kind is None:
            raise PathError("a boundary needs the value as written: a text of a known kind")
        return self.map(lambda c: side(c, kind), T.DoubleType() if kind == "decimal" else T.StringType())

    def as_partial(self) -> PartialDates:
        """The same values, compared as dates and times of their written precision."""
        return PartialDates(self.col, self.dtype, self.plain, self.clean)

    # -- comparison ----------------------------------------------------------------

    def equals(self, other: Any) -> Column:
        """Collection equality: null when a side is empty, false when the sizes differ,
        otherwise item by item in order."""
        if not self.many and not (isinstance(other, Path) and other.many):
            return self.col == value_of(other)
        if not isinstance(other, Path):
            return self._equals_value(other)
        mine, theirs = self.array, other.array
        return F.when((F.array_size(mine) > 0) & (F.array_size(theirs) > 0), mine == theirs)

    def _equals_value(self, other: Any) -> Column:
        """A collection against one value. The usual cases are decided without a lambda:
        the value is not there at all, or it is the only item."""
        v = value_of(other)
        found = F.array_contains(self.col, v)
        result = (
            F.when(found, (F.array_size(self.col) == 1) | (F.array_size(self.compact) == 1))
            .when(F.get(self.col, F.lit(0)).isNotNull(), F.lit(False))
            .when(F.array_size(self.compact) > 0, F.lit(False))
        )
        return F.when(v.isNotNull(), result) if isinstance(other, Column) else result

    def equivalent(self, other: Any, in_order: bool = False) -> Column:
        """Whether both hold the same items as often as each other, whatever their order: text without
        regard to case and runs of blanks. Two empty collections are; the answer is never null.
        With ``in_order`` items are compared one by one in their order."""
        mine, theirs = _normal(self.array, self.item_type), other
        if isinstance(other, Path):
            theirs = _normal(other.array, other.item_type)
        else:
            single = F.array_compact(F.array(value_of(other)))
            theirs = _normal(single, self.item_type)
        if not in_order:
            mine, theirs = F.array_sort(mine), F.array_sort(theirs)
        return (F.size(mine) == F.size(theirs)) & F.coalesce(mine == theirs, F.lit(False))

    def __eq__(self, other: Any) -> Column:  # type: ignore[override]
        return self.equals(other)

    def __ne__(self, other: Any) -> Column:  # type: ignore[override]
        return ~self.equals(other)

    __hash__ = None  # type: ignore[assignment]

    def __lt__(self, other: Any) -> Column:
        return self.one("<") < _one(other)

    def __le__(self, other: Any) -> Column:
        return self.one("<=") <= _one(other)

    def __gt__(self, other: Any) -> Column:
        return self.one(">") > _one(other)

    def __ge__(self, other: Any) -> Column:
        return self.one(">=") >= _one(other)


def _capital(type_name: str) -> str:
    return type_name[0].upper() + type_name[1:]


def _normal(items: Column, kind: T.DataType) -> Column:
    """Items in the form in which equivalent ones are equal."""
    if isinstance(kind, T.StringType):
        return F.transform(items, lambda x: F.lower(F.trim(F.regexp_replace(x, r"\s+", " "))))
    if isinstance(kind, T.NumericType):
        return F.transform(items, lambda x: x.cast("double"))
    return items


class Choice(Path):
    """A choice element without its type, such as ``value`` for all of valueQuantity, valueString, ...

    It is the union of the declared variants. As a value it is text: that of a simple value, the
    JSON text of a record. ``only_type`` and ``is_type`` pick a variant, a further step goes into
    the records of those variants that have the field, and ``==`` compares with the variants of
    the other side's kind.
    """

    def __init__(self, parent: Path, name: str, types: list[str]):
        self.parent, self.name, self.types = parent, name, types
        if parent.many:
            text = F.transform(parent.compact, lambda x: Choice(Path(x, parent.item_type), name, types).col)
            super().__init__(text, T.ArrayType(T.StringType()), False)
        else:
            super().__init__(F.coalesce(*[_as_text(v) for v in self._variants().values()]), T.StringType(), False)

    def _variants(self) -> dict[str, Path]:
        return {t: self.parent[self.name + _capital(t)] for t in self.types}

    def has(self, name: str) -> bool:
        return any(v.has(name) for v in self._variants().values())

    def __getitem__(self, name: str) -> Path:
        fields = [v[name] for v in self._variants().values() if v.has(name)]
        if not fields:
            raise PathError(f"no variant of {self.name!r} has a field {name!r}")
        if len(fields) == 1:
            return fields[0]
        if len({f.dtype.simpleString() for f in fields}) > 1 or self.many:
            raise PathError(f"variants of {self.name!r} have fields {name!r} of several kinds: name the type")
        return fields[0].or_first(*fields[1:]) if not fields[0].many else fields[0].joined(*fields[1:])

    def only_type(self, type_name: str) -> Path:
        if type_name in self.types:
            return self._variants()[type_name]
        return Path(F.lit(None).cast(self.dtype), self.dtype)

    def is_type(self, type_name: str) -> Column:
        return F.when(self.one().isNotNull(), self.only_type(type_name).exists())

    def equals(self, other: Any) -> Column:
        if isinstance(other, (Path, Column)):
            return super().equals(other)
        alike = [v for v in self._variants().values() if _same_kind(v.item_type, other)]
        matches = [F.coalesce(v == other, F.lit(False)) for v in alike]
        found = F.lit(False)
        for m in matches:
            found = found | m
        return F.when(self.exists(), found)


def _as_text(value: Path) -> Column:
    if isinstance(value, WrittenNumbers):
        return value.written.col
    kind = value.dtype
    return F.to_json(value.col) if isinstance(kind, (T.StructType, T.ArrayType)) else value.col.cast("string")


def _same_kind(kind: T.DataType, value: Any) -> bool:
    if isinstance(value, bool):
        return isinstance(kind, T.BooleanType)
    if isinstance(value, str):
        return isinstance(kind, T.StringType)
    return isinstance(kind, T.NumericType)


def _leaf(col: Column, dtype: T.DataType, kind: str | None, plain: bool) -> Path:
    """A field whose comment in the schema says that it is read as text for the sake of its written form."""
    item = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
    if kind in TEMPORAL_TYPES and isinstance(item, T.StringType):
        return PartialDates(col, dtype, plain, kind=kind)
    if kind == "decimal" and isinstance(item, T.StringType):
        return WrittenNumbers(col, dtype, plain)
    return Path(col, dtype, plain)


class PartialDates(Path):
    """Dates and times as text, which may be partial ("2020", "2020-06").

    A comparison is null where the shared part is equal and one side is less precise, as
    ``1960-06`` may be any day of that month. Fields whose comment in the schema is date,
    dateTime, instant or time are such paths.
    """

    def __init__(
        self, col: Column | None, dtype: T.DataType, plain: bool = True, clean: bool = False, kind: str | None = None
    ):
        super().__init__(col, dtype, plain, clean)
        self.kind = kind

    def _like(self, col: Column, dtype: T.DataType, plain: bool = False, clean: bool = False) -> Path:
        return PartialDates(col, dtype, plain, clean, self.kind)

    def _boundary(self, side: Callable[[Column, str], Column], kind: str | None) -> Path:
        return super()._boundary(side, kind or self.kind)

    def distinct(self) -> Path:
        """First of the items that are equal; two that cannot be told apart both stay."""

        def add(kept: Column, x: Column) -> Column:
            known = F.exists(kept, lambda y: F.coalesce(compare_partial(y, x) == 0, F.lit(False)))
            return F.when(known, kept).otherwise(F.concat(kept, F.array(x)))

        none = F.array().cast(T.ArrayType(self.item_type))
        return self._like(F.aggregate(self.array, none, add), T.ArrayType(self.item_type), False, True)

    def union(self, other: Path) -> Path:
        both = F.concat(self.array, other.array)
        return self._like(both, T.ArrayType(self.item_type), False, True).distinct()

    def _order(self, other: Any, label: str) -> Column:
        return compare_partial(self.one(label), _one(other))

    def equals(self, other: Any) -> Column:
        if not self.many and not (isinstance(other, Path) and other.many):
            return self._order(other, "=") == 0
        mine = self.array
        theirs = other.array if isinstance(other, Path) else F.array_compact(F.array(value_of(other)))
        same = F.forall(F.zip_with(mine, theirs, lambda a, b: compare_partial(a, b) == 0), lambda x: x)
        same = F.when(F.array_size(mine) == F.array_size(theirs), same).otherwise(F.lit(False))
        return F.when((F.array_size(mine) > 0) & (F.array_size(theirs) > 0), same)

    def contains_item(self, item: Any) -> Column:
        v = value_of(item)
        return F.when(v.isNotNull(), F.exists(self.array, lambda x: compare_partial(x, v) == 0))

    def __lt__(self, other: Any) -> Column:
        return self._order(other, "<") < 0

    def __le__(self, other: Any) -> Column:
        return self._order(other, "<=") <= 0

    def __gt__(self, other: Any) -> Column:
        return self._order(other, ">") > 0

    def __ge__(self, other: Any) -> Column:
        return self._order(other, ">=") >= 0


class WrittenNumbers(Path):
    """Decimal numbers that keep the text they are written as. They count as numbers everywhere;
    their boundaries come from the written digits, so ``1.50`` reaches from 1.495 to 1.505."""

    def __init__(self, text: Column, dtype: T.DataType, plain: bool = True, clean: bool = False):
        self.written = Path(text, dtype, plain, clean)
        if isinstance(dtype, T.ArrayType):
            number, kind = F.transform(text, lambda x: x.cast("double")), T.ArrayType(T.DoubleType())
        else:
            number, kind = text.cast("double"), T.DoubleType()
        super().__init__(number, kind, False, clean)

    def first(self) -> Path:
        return self._of(self.written.first())

    def last(self) -> Path:
        return self._of(self.written.last())

    def at(self, index: int | Column) -> Path:
        return self._of(self.written.at(index))

    def single(self, label: str = "single()") -> Path:
        return self._of(self.written.single(label))

    @staticmethod
    def _of(written: Path) -> WrittenNumbers:
        return WrittenNumbers(written.col, written.dtype, False, written.clean)

    def _boundary(self, side: Callable[[Column, str], Column], kind: str | None) -> Path:
        return self.written._boundary(side, kind or "decimal")


def _one(x: Any) -> Column:
    return x.one() if isinstance(x, Path) else value_of(x)


def _truth(x: Any) -> Column:
    """A condition as a boolean: a single value that is not a boolean counts as true,
    no value is null, several values are an error."""
    if not isinstance(x, Path):
        return value_of(x)
    one = x.one("condition")
    if isinstance(x.item_type, T.BooleanType):
        return one
    return F.when(one.isNotNull(), F.lit(True))


def iif(condition: Any, then: Any, otherwise: Any = None) -> Column:
    return F.when(F.coalesce(_truth(condition), F.lit(False)), value_of(then)).otherwise(
        value_of(otherwise)
    )


def implies(a: Any, b: Any) -> Column:
    return ~_truth(a) | _truth(b)


def xor(a: Any, b: Any) -> Column:
    return _truth(a) != _truth(b)
