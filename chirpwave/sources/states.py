"""The 50-row US state dimension.

Its size is fixed by definition (50 rows), so it is the one side that is
always safe to broadcast, and the name -> code lookup can be a map
literal evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Display name and postal code of the 50 states, in the
# order used by the dashboard row (index = position).  The lookup key is
# the lower-cased display name.  DC is deliberately absent.
STATES = [
    ("Alabama", "AL"), ("Alaska", "AK"), ("Arizona", "AZ"), ("Arkansas", "AR"),
    ("California", "CA"), ("Colorado", "CO"), ("Connecticut", "CT"), ("Delaware", "DE"),
    ("Florida", "FL"), ("Georgia", "GA"), ("Hawaii", "HI"), ("Idaho", "ID"),
    ("Illinois", "IL"), ("Indiana", "IN"), ("Iowa", "IA"), ("Kansas", "KS"),
    ("Kentucky", "KY"), ("Louisiana", "LA"), ("Maine", "ME"), ("Maryland", "MD"),
    ("Massachusetts", "MA"), ("Michigan", "MI"), ("Minnesota", "MN"), ("Mississippi", "MS"),
    ("Missouri", "MO"), ("Montana", "MT"), ("Nebraska", "NE"), ("Nevada", "NV"),
    ("New Hampshire", "NH"), ("New Jersey", "NJ"), ("New Mexico", "NM"), ("New York", "NY"),
    ("North Carolina", "NC"), ("North Dakota", "ND"), ("Ohio", "OH"), ("Oklahoma", "OK"),
    ("Oregon", "OR"), ("Pennsylvania", "PA"), ("Rhode Island", "RI"), ("South Carolina", "SC"),
    ("South Dakota", "SD"), ("Tennessee", "TN"), ("Texas", "TX"), ("Utah", "UT"),
    ("Vermont", "VT"), ("Virginia", "VA"), ("Washington", "WA"), ("West Virginia", "WV"),
    ("Wisconsin", "WI"), ("Wyoming", "WY"),
]

# Fixed value: the code given to places that do not resolve to a state.
UNDEFINED = "UND"

STATE_DIM_SCHEMA = T.StructType([
    T.StructField("state_idx", T.IntegerType(), False),
    T.StructField("state", T.StringType(), False),
    T.StructField("code", T.StringType(), False),
])


def state_dim(spark: SparkSession) -> DataFrame:
    """50-row dimension ``(state_idx, state, code)``, marked for broadcast."""
    rows = [(i, name, code) for i, (name, code) in enumerate(STATES)]
    return F.broadcast(spark.createDataFrame(rows, STATE_DIM_SCHEMA))


def state_lookup() -> Column:
    """Map literal ``lower(name) -> code``; looked up with ``try_element_at``."""
    kv = []
    for name, code in STATES:
        kv += [F.lit(name.lower()), F.lit(code)]
    return F.create_map(*kv)


def states_values_sql() -> str:
    """The same 50 rows as a SQL ``VALUES`` relation (for DuckDB oracles)."""
    rows = ",".join(f"({i},'{n}','{c}')" for i, (n, c) in enumerate(STATES))
    return f"(SELECT * FROM (VALUES {rows}) AS t(state_idx, state, code))"
