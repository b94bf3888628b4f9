"""Schema comparison against its definition, on generated schemas."""

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from driftgate.operators import compare_schema
from driftgate.settings import ADDED, REMOVED, REMOVED_CRITICAL, RETYPED_SAFE
from driftgate.sources import Contract

names = st.sampled_from(["a", "b", "c", "A", "_m", "x.y", "d"])
kinds = st.sampled_from([
    T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType(), T.DecimalType(9, 2),
    T.ArrayType(T.StringType()),
])
schemas = st.dictionaries(names, kinds, max_size=6)


def struct(columns, nullable=True):
    return T.StructType([T.StructField(n, t, nullable) for n, t in columns.items()])


@given(expected=schemas, actual=schemas, critical=st.sets(names))
def test_findings_follow_from_the_two_schemas(expected, actual, critical):
    contract = Contract("e", struct(expected), frozenset(critical), ())
    findings = compare_schema(struct(actual, nullable=False), contract)
    wanted = {n: t for n, t in expected.items() if not n.startswith("_")}
    got = {n: t for n, t in actual.items() if not n.startswith("_")}
    added = [(ADDED, n) for n in sorted(got.keys() - wanted.keys())]
    removed = [
        (REMOVED_CRITICAL if n in critical else REMOVED, n) for n in sorted(wanted.keys() - got.keys())
    ]
    retyped = [(RETYPED_SAFE, n) for n in sorted(wanted.keys() & got.keys()) if wanted[n] != got[n]]
    assert [(f.anomaly_type, f.field) for f in findings] == added + removed + retyped
    for f in findings:
        numeric = isinstance(f.expected, (T.DoubleType, T.IntegerType))
        assert (f.probe is not None) == (isinstance(f.actual, T.StringType) and numeric)


@given(columns=schemas)
def test_a_schema_meets_itself(columns):
    assert compare_schema(struct(columns), Contract("e", struct(columns), frozenset(), ())) == []
