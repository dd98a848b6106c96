"""Declarations shared by every operator: fields, links and contracts.

A contract is plain data. It gives the fixed schema a table is read with, the rules a request row must keep, the
columns a response shows, the unique key and the parent links. Nothing here touches Spark beyond its type objects.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

RESTRICT = "restrict"
CASCADE = "cascade"
SET_NULL = "set_null"


@dataclass(frozen=True)
class Field:
    """One column and its row rules. ``type`` is a Spark DDL type name."""

    name: str
    type: str
    required: bool = True
    gt: float | None = None
    ge: float | None = None
    le: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    email: bool = False
    default: Any = None
    # Hidden fields are stored but neither accepted in a body nor shown in a response.
    hidden: bool = False


@dataclass(frozen=True)
class Link:
    """A foreign key: ``column`` of the owning contract refers to the key of ``parent``."""

    column: str
    parent: str
    on_delete: str = RESTRICT


@dataclass(frozen=True)
class Contract:
    """Fixed schema and rules of one table."""

    name: str
    key: str
    fields: tuple[Field, ...]
    key_type: str = "int"
    unique: tuple[str, ...] = ()
    links: tuple[Link, ...] = ()

    @property
    def body_fields(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if not f.hidden)

    @property
    def columns(self) -> list[str]:
        return [self.key, *(f.name for f in self.fields)]

    @property
    def response_columns(self) -> list[str]:
        return [self.key, *(f.name for f in self.body_fields)]

    @property
    def schema(self) -> T.StructType:
        ddl = [f"{self.key} {self.key_type}", *(f"{f.name} {f.type}" for f in self.fields)]
        return T.StructType.fromDDL(", ".join(ddl))

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)
