"""Property: rescue loses no field. Every key of every JSON line is either a
non-null typed column, or in ``_rescued_data``, or was null in the input."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeingest.functions import rescue

KEYS = ["a", "b", "c", "d", "e"]
TYPES = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType()}

values = st.one_of(st.none(), st.integers(-10**12, 10**12), st.floats(allow_nan=False, allow_infinity=False),
                   st.text(max_size=5), st.booleans(), st.dictionaries(st.sampled_from(["x", "y"]), st.integers(), max_size=2))
records = st.dictionaries(st.sampled_from(KEYS), values, max_size=5)
schemas = st.dictionaries(st.sampled_from(KEYS[:4]), st.sampled_from(sorted(TYPES)), min_size=1, max_size=4)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(records, min_size=1, max_size=30), schemas, st.booleans())
def test_rescue_loses_no_field(spark, recs, declared, text_types):
    schema = T.StructType([T.StructField(k, TYPES[t]) for k, t in sorted(declared.items())])
    lines = spark.createDataFrame([(json.dumps(r),) for r in recs], "_line STRING")
    parsed = lines.select("_line", *rescue.json_parse(F.col("_line"), schema, text_types))
    typed = parsed.select(*rescue.json_typed(schema, text_types), rescue.PARSED, rescue.KEYS, "_line")
    out = typed.select("_line", *[f.name for f in schema.fields],
                       rescue.json_rescue(F.col("_line"), schema, text_types)).collect()
    assert len(out) == len(recs)
    for row in out:
        rec = json.loads(row["_line"])
        rescued = json.loads(row["_rescued_data"]) if row["_rescued_data"] else {}
        whole = "_corrupt_record" in rescued
        for key, value in rec.items():
            kept = (key in declared and row[key] is not None) or key in rescued or value is None or whole
            assert kept, (key, value, row)
        for key in rescued:
            assert key in rec or key == "_corrupt_record"
        for f in schema.fields:
            if row[f.name] is not None and f.name not in rescued:
                assert f.name in rec
