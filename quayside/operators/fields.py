"""How the fields of a document frame are searched: as text or as keywords.

A ``text`` field is matched token by token, any other field by its whole
value. Strings are text unless the mapping says ``keyword``. An array field
holds several values, any of which may match; a dotted name is a field of a
struct, or of all structs of an array, whose values are then those of one field.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, NumericType, StringType, StructType

from quayside.functions import tokens as tk


def field_kinds(mapping: Mapping | None) -> dict[str, str]:
    """Field types of a mapping, ``{"properties": {name: {"type": kind}}}`` or ``{name: kind}``.

    Fields of objects, which have ``properties`` of their own, are named by their path.
    """
    kinds = {}
    for name, spec in (mapping or {}).get("properties", mapping or {}).items():
        if not isinstance(spec, Mapping):
            kinds[name] = spec
            continue
        if "type" in spec:
            kinds[name] = spec["type"]
        for inner, kind in field_kinds(spec).items() if "properties" in spec else ():
            kinds[f"{name}.{inner}"] = kind
    return kinds


def leaf_paths(schema: StructType, before: str = "") -> list[str]:
    """Names of the columns, and paths of the fields of structs and of arrays of them."""
    found = []
    for field in schema.fields:
        inner = field.dataType
        while isinstance(inner, ArrayType):
            inner = inner.elementType
        path = before + field.name
        found += leaf_paths(inner, f"{path}.") if isinstance(inner, StructType) else [path]
    return found


def _inside(column: Column | None, data_type: DataType, name: str) -> tuple[Column | None, DataType | None]:
    """A field of a struct, or the values that it has in the structs of an array, as one array."""
    if isinstance(data_type, ArrayType):
        inner, inner_type = _inside(F.lit(None), data_type.elementType, name)
        if inner is None:
            return None, None
        several = isinstance(inner_type, ArrayType)
        none = F.array().cast(inner_type) if several else None

        def value(element: Column) -> Column:
            found = _inside(element, data_type.elementType, name)[0]
            return F.coalesce(found, none) if several else found

        values = F.transform(column, value)
        values = F.flatten(values) if several else F.filter(values, lambda v: v.isNotNull())
        return values, inner_type if several else ArrayType(inner_type)
    if not isinstance(data_type, StructType) or name not in data_type.names:
        return None, None
    return F.col(f"`{name}`") if column is None else column.getField(name), data_type[name].dataType


def wildcard_to_like(wildcard: str) -> str:
    escaped = "".join("\\" + c if c in "\\%_" else c for c in wildcard)
    return escaped.replace("*", "%").replace("?", "_")


@dataclass(frozen=True)
class Field:
    """Conditions on one field; a field that does not exist matches nothing."""

    column: Column | None
    type: DataType | None
    is_text: bool

    @property
    def value_type(self) -> DataType | None:
        return self.type.elementType if isinstance(self.type, ArrayType) else self.type

    @property
    def is_string(self) -> bool:
        return isinstance(self.value_type, StringType)

    @property
    def is_keyword(self) -> bool:
        """A single value that is compared whole."""
        return self.type is not None and not self.is_text and not isinstance(self.type, ArrayType)

    def _any_value(self, condition: Callable[[Column], Column]) -> Column:
        """The condition holds for the value, or for one of the values of an array; an object itself has no value."""
        if self.type is None or isinstance(self.value_type, (ArrayType, MapType, StructType)):
            return F.lit(False)
        if isinstance(self.type, ArrayType):
            return F.exists(self.column, lambda value: condition(value))
        return condition(self.column)

    def _as_string(self, value: Column) -> Column:
        return value if self.is_string else value.cast("string")

    def analysed(self, value: str) -> list[str]:
        return tk.analyse(value) if self.is_text else [value]

    def token_array(self) -> Column:
        """All terms of the field; NULL elements of an array have none."""
        if not isinstance(self.type, ArrayType):
            return tk.tokens(self.column) if self.is_text else F.array(self._as_string(self.column))
        values = F.filter(self.column, lambda value: value.isNotNull())
        if self.is_text:
            return F.flatten(F.transform(values, lambda value: tk.tokens(value)))
        return F.transform(values, lambda value: self._as_string(value))

    def any_term(self, terms: Sequence[str]) -> Column:
        """One of the terms is a token of a text, or the whole value of another field."""
        if self.is_text:
            return self._any_value(lambda value: tk.has_any_token(value, terms))
        return self.any_value(terms)

    def any_value(self, values: Sequence[str]) -> Column:
        """The whole value, written as text, is one of the values."""
        if self.is_string:
            return self._any_value(lambda value: value.isin(list(values)))
        return self._any_value(lambda value: value.isin([F.lit(v).try_cast(self.value_type) for v in values]))

    def match(self, *texts: str) -> Column:
        """The field shares a term with one of the texts."""
        return self.any_term([term for text in texts for term in self.analysed(text)])

    def phrase(self, text: str, slop: int = 0) -> Column:
        """The words of the text next to each other, or moved by ``slop`` places in all."""
        if self.is_text:
            return self._any_value(lambda value: tk.has_loose_phrase(value, tk.analyse(text), slop))
        return self.any_value([text])

    def prefix(self, start: str) -> Column:
        if self.is_text:
            return self._any_value(lambda value: tk.has_token_prefix(value, start))
        return self._any_value(lambda value: self._as_string(value).startswith(start))

    def wildcard(self, pattern: str) -> Column:
        if self.is_text:
            return self._any_value(lambda value: tk.has_token_like(value, pattern))
        return self._any_value(lambda value: self._as_string(value).like(wildcard_to_like(pattern)))

    def regex(self, pattern: str) -> Column:
        if self.is_text:
            return self._any_value(lambda value: tk.has_token_matching(value, pattern))
        return self._any_value(lambda value: tk.full_match(self._as_string(value), pattern))

    def fuzzy(self, word: str, edits: int | None = None) -> Column:
        edits = tk.auto_edits(word) if edits is None else edits
        if self.is_text:
            return self._any_value(lambda value: tk.has_token_within(value, word, edits))
        return self._any_value(lambda value: tk.within_edits(self._as_string(value), word, edits))

    def exists(self) -> Column:
        if self.type is None:
            return F.lit(False)
        present = self.column.isNotNull()
        return present & (F.size(self.column) > 0) if isinstance(self.type, ArrayType) else present

    def between(
        self, low: Column | None, high: Column | None, open_low: bool = False, open_high: bool = False
    ) -> Column:
        """The value lies between the bounds, each optional, inclusive unless open."""
        if low is None and high is None:
            return self.exists()

        def inside(value: Column) -> Column:
            bounds = []
            if low is not None:
                bounds.append(value > low if open_low else value >= low)
            if high is not None:
                bounds.append(value < high if open_high else value <= high)
            return tk.all_of(bounds)

        return self._any_value(inside)


@dataclass(frozen=True)
class Documents:
    """A document frame with its mapping and the name of its id column."""

    frame: DataFrame
    mapping: Mapping | None = None
    id_column: str = "_id"
    kinds: Mapping[str, str] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "kinds", field_kinds(self.mapping))

    def _resolve(self, name: str) -> tuple[Column | None, DataType | None]:
        """Column and type of a name, or of a path into structs and arrays of structs."""
        if name in self.frame.columns:
            return F.col(f"`{name}`"), self.frame.schema[name].dataType
        column, data_type = None, self.frame.schema
        for part in name.split("."):
            column, data_type = _inside(column, data_type, part)
            if data_type is None:
                return None, None
        return column, data_type

    def field(self, name: str) -> Field:
        column, data_type = self._resolve(name)
        is_string = isinstance(Field(column, data_type, False).value_type, StringType)
        return Field(column, data_type, is_string and self.kinds.get(name, "text") == "text")

    def searchable(self) -> list[Field]:
        """Fields that a search without a field name looks into."""
        fields = [self.field(name) for name in leaf_paths(self.frame.schema) if name != self.id_column]
        return [f for f in fields if isinstance(f.value_type, (StringType, NumericType))]
