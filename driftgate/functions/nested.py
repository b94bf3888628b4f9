"""Values inside structs, arrays and maps: reaching them, and rebuilding what holds them.

A path is written as in Spark's DDL, ``items.element.price`` or ``tags.value``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftgate.functions.columns import quoted

ELEMENT, VALUE = "element", "value"


@dataclass(frozen=True)
class Step:
    """One level down: into the named field of a struct, or into every element or value."""

    name: str
    each: bool = False


def path_text(column: str, steps: Sequence[Step]) -> str:
    """The path as text; names that hold dots or backticks are quoted where there are steps."""
    if not steps:
        return column
    names = [column, *(step.name for step in steps)]
    return ".".join(quoted(name) if "." in name or "`" in name else name for name in names)


def differences(
    actual: T.DataType, expected: T.DataType, steps: tuple[Step, ...] = ()
) -> Iterator[tuple[tuple[Step, ...], T.DataType | None, T.DataType | None]]:
    """Where two types differ: the steps there, and the type on either side, None where that side has nothing.

    Nullability and the order of fields do not matter. Maps with different keys differ as a whole.
    """
    if actual.simpleString() == expected.simpleString():
        return
    if isinstance(actual, T.StructType) and isinstance(expected, T.StructType):
        ours, theirs = ({f.name: f.dataType for f in kind.fields} for kind in (actual, expected))
        for name in ours | theirs:
            deeper = (*steps, Step(name))
            if name in ours and name in theirs:
                yield from differences(ours[name], theirs[name], deeper)
            else:
                yield deeper, ours.get(name), theirs.get(name)
    elif isinstance(actual, T.ArrayType) and isinstance(expected, T.ArrayType):
        yield from differences(actual.elementType, expected.elementType, (*steps, Step(ELEMENT, True)))
    elif (
        isinstance(actual, T.MapType) and isinstance(expected, T.MapType)
        and actual.keyType.simpleString() == expected.keyType.simpleString()
    ):
        yield from differences(actual.valueType, expected.valueType, (*steps, Step(VALUE, True)))
    else:
        yield steps, actual, expected


def anywhere(value: Column, steps: Sequence[Step], test: Callable[[Column], Column]) -> Column:
    """True where ``test`` holds for the value at the end of the steps, or for any of several; never null if it never is."""
    if not steps:
        return test(value)
    step, rest = steps[0], steps[1:]
    if not step.each:
        return anywhere(value.getField(step.name), rest, test)
    values = F.map_values(value) if step.name == VALUE else value
    return F.coalesce(F.exists(values, lambda v: anywhere(v, rest, test)), F.lit(False))


def reshaped(value: Column, actual: T.DataType, expected: T.DataType, cast: bool = False) -> Column:
    """``value`` with the fields that ``expected`` has, in its order: others dropped, missing ones null.

    Retyped leaves stay as they are, or with ``cast`` text among them becomes the expected type.
    """
    if actual.simpleString() == expected.simpleString():
        return value
    if isinstance(actual, T.StructType) and isinstance(expected, T.StructType):
        ours = {f.name: f.dataType for f in actual.fields}
        fields = [
            (
                reshaped(value.getField(f.name), ours[f.name], f.dataType, cast)
                if f.name in ours else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in expected.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(actual, T.ArrayType) and isinstance(expected, T.ArrayType):
        return F.transform(value, lambda v: reshaped(v, actual.elementType, expected.elementType, cast))
    if (
        isinstance(actual, T.MapType) and isinstance(expected, T.MapType)
        and actual.keyType.simpleString() == expected.keyType.simpleString()
    ):
        return F.transform_values(value, lambda _, v: reshaped(v, actual.valueType, expected.valueType, cast))
    nested = (T.StructType, T.ArrayType, T.MapType)
    if cast and isinstance(actual, T.StringType) and not isinstance(expected, nested):
        return value.try_cast(expected)
    return value
