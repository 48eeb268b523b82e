"""Versioned data contracts, compiled to Column rules.

A contract is read once on the driver. What leaves it is a list of rules, each
a boolean Column with a message Column, so that a check of any size is a plain
projection over the rows.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, fields as dataclass_fields
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.text import number_text
from tablegate.functions.time import parse_utc
from tablegate.operators.once import computed_once


class ContractError(RuntimeError):
    """The contract is missing, malformed or uses an unknown type."""


# Contract types and the Spark types that carry them.
SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
}


def _value_kind(data_type: T.DataType) -> str:
    """Name of a value's type as reasons spell it."""
    match data_type:
        case T.BooleanType():
            return "boolean"
        case T.StringType() | T.VarcharType() | T.CharType():
            return "str"
        case T.IntegralType():
            return "int"
        case T.DecimalType():
            return "int" if data_type.scale == 0 else "float"
        case T.FractionalType():
            return "float"
        case T.TimestampType() | T.TimestampNTZType():
            return "datetime"
        case T.DateType():
            return "date"
        case T.ArrayType():
            return "list"
        case T.MapType() | T.StructType():
            return "dict"
        case T.BinaryType():
            return "bytes"
        case _:
            return data_type.simpleString()


# Value kinds each contract type accepts; an int is a valid float.
ACCEPTED_KINDS = {
    "string": ("str",),
    "integer": ("int",),
    "float": ("float", "int"),
    "boolean": ("boolean",),
    "timestamp": ("datetime",),
}


# Prefixes of the columns that hold a decoded variant while it is checked.
_VALUE, _TYPE, _PARSED = "__value_", "__type_", "__parsed_"


@dataclass(frozen=True)
class Rule:
    """``failed`` is never null; ``message`` is only read where it is true."""

    field: str
    failed: Column
    message: Column


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str
    required: bool = False
    min: float | None = None
    max: float | None = None
    description: str | None = None

    def rules(self, value: Column | None, data_type: T.DataType | None) -> list[Rule]:
        """Rules for a column of ``data_type``; ``value`` None means absent."""
        if value is None or isinstance(data_type, T.NullType):
            return [self._rule(F.lit(True), "required field is null")] if self.required else []

        present = value.isNotNull()
        rules = [self._rule(~present, "required field is null")] if self.required else []
        if self.type not in ACCEPTED_KINDS:
            return [*rules, self._unknown_type(present)]
        kind = _value_kind(data_type)
        if kind not in ACCEPTED_KINDS[self.type]:
            return [*rules, self._rule(present, f"expected {self.type}, got {kind}")]
        if kind == "int":
            return rules + self._range(value, value.cast("string"))
        if kind == "float":
            number = value.cast("double")
            return rules + self._range(number, number_text(number))
        if kind == "boolean":
            return rules + self._range(value.cast("double"), F.initcap(value.cast("string")))
        return rules

    def prepared(self, value: Column) -> dict[str, Column]:
        """What the rules ask of a variant."""
        columns = {_VALUE + self.name: value, _TYPE + self.name: F.schema_of_variant(value)}
        if self.type in ("integer", "float", "boolean"):
            columns[_PARSED + self.name] = F.try_variant_get(value, "$", "double")
        elif self.type == "timestamp":  # JSON has no timestamps, only their text
            columns[_PARSED + self.name] = parse_utc(F.try_variant_get(value, "$", "string"))
        return columns

    def variant_rules(self) -> list[Rule]:
        """Rules over the columns of :meth:`prepared`."""
        value, stored = F.col(_VALUE + self.name), F.col(_TYPE + self.name)
        present = F.coalesce(stored != "VOID", F.lit(False))
        rules = [self._rule(~present, "required field is null")] if self.required else []
        if self.type not in ACCEPTED_KINDS:
            return [*rules, self._unknown_type(present)]

        is_float = stored.startswith("DECIMAL") | stored.isin("DOUBLE", "FLOAT")
        fits = {
            "string": stored == "STRING",
            "integer": stored == "BIGINT",
            "float": (stored == "BIGINT") | is_float,
            "boolean": stored == "BOOLEAN",
            "timestamp": stored.startswith("TIMESTAMP")
            | ((stored == "STRING") & F.col(_PARSED + self.name).isNotNull())
            if self.type == "timestamp"
            else None,
        }[self.type]
        kind = (
            F.when(stored == "STRING", "str")
            .when(stored == "BIGINT", "int")
            .when(is_float, "float")
            .when(stored == "BOOLEAN", "boolean")
            .when(stored.startswith("TIMESTAMP"), "datetime")
            .when(stored == "DATE", "date")
            .when(stored.startswith("ARRAY"), "list")
            .when(stored.startswith("OBJECT"), "dict")
            .otherwise(stored)
        )
        message = F.concat(F.lit(f"{self.name}: expected {self.type}, got "), kind)
        rules.append(Rule(self.name, present & ~F.coalesce(fits, F.lit(False)), message))
        if self.type in ("integer", "float", "boolean"):
            number = F.col(_PARSED + self.name)
            text = (
                F.when(is_float, number_text(number))
                .when(stored == "BOOLEAN", F.initcap(F.to_json(value)))
                .otherwise(F.to_json(value))
            )
            rules += self._range(F.when(fits, number), text)
        return rules

    def _range(self, number: Column, text: Column) -> list[Rule]:
        rules = []
        # NaN compares greater than any number in Spark; it is refused by name.
        nan = F.isnan(number.cast("double"))
        if self.min is not None or self.max is not None:
            rules.append(self._rule(nan, "nan is not a number in the contract range"))
        low = None if self.min is None else F.coalesce((number < self.min) & ~nan, F.lit(False))
        high = None if self.max is None else F.coalesce((number > self.max) & ~nan, F.lit(False))
        below, above = f" below contract minimum {self.min}", f" above contract maximum {self.max}"

        def rule(failed: Column, words: Column) -> Rule:
            return Rule(self.name, failed, F.concat(F.lit(f"{self.name}: "), text, words))

        if low is not None and high is not None and self.min <= self.max:
            # One rule for both: the text of the value is costly to generate code for.
            return [*rules, rule(low | high, F.when(low, below).otherwise(above))]
        if low is not None:
            rules.append(rule(low, F.lit(below)))
        if high is not None:
            rules.append(rule(high, F.lit(above)))
        return rules

    def _rule(self, failed: Column, message: str) -> Rule:
        return Rule(self.name, F.coalesce(failed, F.lit(False)), F.lit(f"{self.name}: {message}"))

    def _unknown_type(self, present: Column) -> Rule:
        text = f"unknown type '{self.type}' for field '{self.name}'"
        return self._rule(F.when(present, F.raise_error(F.lit(text)).cast("boolean")), text)


@dataclass(frozen=True)
class Contract:
    name: str
    version: int
    fields: tuple[FieldSpec, ...]
    grain: str = ""
    primary_key: tuple[str, ...] = ()
    partition_key: str = ""
    source_lag_days: int = 0
    freshness_warn_hours: int = 30
    freshness_error_hours: int = 48
    unknown_field_action: str = "warn_and_keep"

    @classmethod
    def load(cls, name: str, version: int, folder: str | Path = "contracts") -> Contract:
        """Read ``<name>.v<version>.yml`` (or ``.json``) from ``folder``."""
        base = Path(folder) / f"{name}.v{version}"
        for path in (base.with_name(base.name + ".yml"), base.with_name(base.name + ".json")):
            if path.exists():
                text = path.read_text(encoding="utf-8")
                return cls.from_document(_parse(path, text), str(path))
        raise ContractError(f"contract file not found: {base}.yml")

    @classmethod
    def from_document(cls, document: Mapping[str, Any], origin: str = "document") -> Contract:
        try:
            allowed = {f.name for f in dataclass_fields(FieldSpec)}
            for field in document["fields"]:
                if extra := sorted(set(field) - allowed):
                    raise ContractError(f"malformed contract {origin}: unknown keys {extra}")
            compatibility = document.get("compatibility", {})
            limits = {
                name: int(document["sla"][name])
                for name in ("freshness_warn_hours", "freshness_error_hours")
                if name in document["sla"]
            }
            return cls(
                name=document["name"],
                version=int(document["version"]),
                fields=tuple(FieldSpec(**field) for field in document["fields"]),
                grain=document["grain"],
                primary_key=tuple(document["primary_key"]),
                partition_key=document["partition_key"],
                source_lag_days=int(document["sla"]["source_lag_days"]),
                unknown_field_action=compatibility.get("unknown_field_action", "warn_and_keep"),
                **limits,
            )
        except (AttributeError, KeyError, TypeError, ValueError) as error:
            raise ContractError(f"malformed contract {origin}: {error!r}") from error

    @property
    def id(self) -> str:
        return f"{self.name}.v{self.version}"

    @property
    def field_names(self) -> list[str]:
        return [spec.name for spec in self.fields]

    def to_struct(self) -> T.StructType:
        """Schema of accepted rows."""
        struct = T.StructType()
        for spec in self.fields:
            if spec.type not in SPARK_TYPES:
                raise ContractError(f"unknown type '{spec.type}' for field '{spec.name}'")
            struct.add(spec.name, SPARK_TYPES[spec.type], not spec.required)
        return struct

    def prepare(self, df: DataFrame, document: str | None = None) -> DataFrame:
        """Decode what has to be checked value by value.

        That is every field of the variant column ``document`` when given, else
        the fields whose column is a variant. Typed columns are left alone, so
        filters on them still reach the scan.
        """
        columns = {}
        for spec in self.fields:
            if document is not None:
                value = F.try_variant_get(F.col(document), f"$['{spec.name}']", "variant")
            elif spec.name in df.columns and isinstance(df.schema[spec.name].dataType, T.VariantType):
                value = F.col(f"`{spec.name}`")
            else:
                continue
            columns |= spec.prepared(value)
        return computed_once(df, columns) if columns else df

    def rules(self, prepared: DataFrame, document: str | None = None) -> list[Rule]:
        """All rules in contract order, over the frame from :meth:`prepare`."""
        rules = []
        for spec in self.fields:
            if _VALUE + spec.name in prepared.columns:
                rules += spec.variant_rules()
            elif spec.name in prepared.columns:
                rules += spec.rules(F.col(f"`{spec.name}`"), prepared.schema[spec.name].dataType)
            else:
                rules += spec.rules(None, None)
        if self.unknown_field_action == "reject":
            rules += self._unknown_rules(prepared, document)
        return rules

    def unknown_names(self, document: Column) -> Column:
        """Sorted names in a variant object that the contract does not describe."""
        names = F.map_keys(F.try_variant_get(document, "$", "map<string,variant>"))
        foreign = F.filter(names, lambda n: ~n.startswith("_") & (n != "") & ~n.isin(self.field_names))
        return F.array_sort(foreign)

    def unknown_columns(self, df: DataFrame) -> list[str]:
        return sorted(
            c for c in df.columns if c and not c.startswith("_") and c not in self.field_names
        )

    def _unknown_rules(self, df, document) -> list[Rule]:
        prefix = "unknown fields not allowed by contract: ["
        if document is None:
            names = self.unknown_columns(df)
            text = prefix + ", ".join(f"'{n}'" for n in names) + "]"
            return [Rule("", F.lit(True), F.lit(text))] if names else []
        names = self.unknown_names(F.col(document))
        quoted = F.array_join(F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", ")
        failed = F.coalesce(F.size(names) > 0, F.lit(False))
        return [Rule("", failed, F.concat(F.lit(prefix), quoted, F.lit("]")))]

    def typed(self, prepared: DataFrame) -> list[Column]:
        """The contract's fields as typed columns, over the frame from :meth:`prepare`."""
        columns = []
        for spec in self.fields:
            target = SPARK_TYPES[spec.type]
            if _VALUE + spec.name not in prepared.columns:
                known = spec.name in prepared.columns
                typed = (F.col(f"`{spec.name}`") if known else F.lit(None)).cast(target)
            elif spec.type in ("float", "timestamp"):
                typed = F.col(_PARSED + spec.name)
            else:
                value = F.col(_VALUE + spec.name)
                typed = F.try_variant_get(value, "$", target.simpleString())
            columns.append(typed.alias(spec.name))
        return columns


def _parse(path: Path, text: str) -> Any:
    if path.suffix == ".json":
        return json.loads(text)
    try:
        import yaml
    except ImportError as error:
        raise ContractError("reading YAML contracts needs PyYAML; use JSON instead") from error
    try:
        return yaml.safe_load(text)
    except yaml.YAMLError as error:
        raise ContractError(f"malformed contract {path}: {error}") from error
