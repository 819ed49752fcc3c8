"""Processing-time lookup with a bounded wait for late dimension rows.

A fact whose dimension row is missing is held for up to ``wait_seconds``;
if the row arrives in time the fact is emitted enriched, otherwise it is
emitted with NULL attributes when its timer fires. Facts whose dimension is
present are emitted at once. Every version of a fact waits and comes out by itself.
All dimension rows are kept in the state, so this form is for small dimensions; `start_wait`
(chain.py) waits without state for the rest.

Spark plan: the fact stream and the dimension change stream are unioned
into one flat, tagged stream, grouped by a hash of the join key and processed by a
``transformWithStateInPandas`` processor with processing-time timers:

* ``MapState`` ``dims``: (key, salt) -> the key's current dimension row (or a tombstone)
  with its arrival; an older arrival never overwrites a newer one.
* ``MapState`` ``pending``: (key, salt, fact id, arrival, kind) -> fact columns and deadline.

Skew: one key (a busy doctor) may carry a large share of the facts, so the
state is dealt by ``(key, salt)`` with ``salt = hash(fact id) mod n``; each
dimension change is copied to the ``n`` salts of its key. A fact and its
retraction share a salt. State holds ``n`` copies of each dimension row.

Inside one batch a key's dimension changes are applied before its facts.
A fact retraction (``-U``/``-D``) cancels pending versions of the same id that
are not newer than itself and is passed on without attributes (only its key matters downstream). Facts
with a NULL key never match, so they bypass the state entirely.

Note: with ``trigger(availableNow=True)`` a query holding processing-time
timers keeps running empty batches, so run it with a processing-time
trigger and stop it explicitly.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from carelake.sources.specs import ARRIVAL, ROWKIND

# The processor runs in Python workers on the executors. Pickling this module
# by value ships its code with the query, so executors need no installed copy
# of the package.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: install the package instead
    pass

# plain names: Arrow batches rename columns that start with "__"
_TAG, _KEY, _SALT, _GROUP = "lk_tag", "lk_key", "lk_salt", "lk_group"
#: State groups to which (key, salt) pairs are dealt by hash; fixed for a checkpoint.
STATE_GROUPS = 1024
_RETRACT = ("-U", "-D")
_KIND_RANK = {"-U": 0, "+I": 1, "+U": 1, "-D": 2}


def _py(v):
    """pandas cell -> plain Python value (NaN/NaT -> None)."""
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    if hasattr(v, "item"):
        return v.item()
    return v


_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
_FRACTIONAL = (T.DoubleType, T.FloatType)


def _converter(dtype: T.DataType):
    """Cell converter to the Python type the state store expects for ``dtype``.

    A pandas column of a group that mixes fact and dimension rows holds
    NULLs, so integral columns arrive as floats; they are cast back here.
    """
    if isinstance(dtype, _INTEGRAL):
        return lambda v: None if (v := _py(v)) is None else int(v)
    if isinstance(dtype, _FRACTIONAL):
        return lambda v: None if (v := _py(v)) is None else float(v)
    if isinstance(dtype, T.BooleanType):
        return lambda v: None if (v := _py(v)) is None else bool(v)
    if isinstance(dtype, T.StringType):
        return lambda v: None if (v := _py(v)) is None else str(v)
    return _py


class _WaitProcessor(StatefulProcessor):
    """Per state group, for each (key, salt) in it: the dimension row, a count of waiting facts, the waiting facts.

    A call of Python costs milliseconds whatever it holds and a state call a round trip to the JVM, so one call takes a
    group of keys, a key costs one look at ``dims`` (which also carries the number of its waiting facts) and one
    update, and ``pending`` is read, once a call, only when something waits.
    """

    def __init__(self, fact_fields: Sequence[T.StructField], dim_fields: Sequence[T.StructField],
                 fact_id: str, wait_ms: int, key_type: T.DataType, order: Sequence[str] = (ARRIVAL,)):
        self.fact_fields = list(fact_fields)
        self.dim_fields = list(dim_fields)
        self.fact_cols = [f.name for f in fact_fields]
        self.dim_cols = [f.name for f in dim_fields]
        self.fact_id = fact_id
        self.id_pos = self.fact_cols.index(fact_id)
        self.order_pos = [self.fact_cols.index(c) for c in order]
        self.wait_ms, self.key_type, self.key_conv = int(wait_ms), key_type, _converter(key_type)
        self.fact_conv = [_converter(f.dataType) for f in self.fact_fields]
        self.dim_conv = [_converter(f.dataType) for f in self.dim_fields]
        self.no_attrs = (None,) * len(self.dim_cols)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        dim_schema = T.StructType([T.StructField("live", T.BooleanType()),
                                   T.StructField("arrival", T.LongType()),
                                   T.StructField("waiting", T.LongType()), *self.dim_fields])
        pending_schema = T.StructType([*self.fact_fields, T.StructField("deadline", T.LongType())])
        id_type = self.fact_fields[self.id_pos].dataType
        key = [T.StructField("key", self.key_type), T.StructField("salt", T.IntegerType())]
        self.dims = handle.getMapState("dims", T.StructType(key), dim_schema)
        self.pending = handle.getMapState("pending", T.StructType([
            *key, T.StructField("id", id_type), T.StructField("arrival", T.LongType()),
            T.StructField("kind", T.StringType())]), pending_schema)

    def _rank(self, values: tuple) -> tuple:
        """A version's order; NULL ranks lowest."""
        return tuple((values[p] is not None, values[p]) if values[p] is not None else (False,) for p in self.order_pos)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.fact_cols + self.dim_cols)

    def _held(self) -> dict[tuple, dict[tuple, tuple]]:
        """The group's waiting facts by (key, salt)."""
        held: dict[tuple, dict[tuple, tuple]] = {}
        for k, v in self.pending.iterator():
            held.setdefault(tuple(k[:2]), {})[tuple(k)] = tuple(v)
        return held

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        chunks = list(rows)
        pdf = chunks[0] if len(chunks) == 1 else pd.concat(chunks, ignore_index=True)
        # one conversion per column; the rest is plain Python
        tags, kinds = pdf[_TAG].tolist(), pdf[ROWKIND].tolist()
        arrivals = [None if (v := _py(a)) is None else int(v) for a in pdf[ARRIVAL].tolist()]
        dim_cols = [pdf[f"d_{c}"].tolist() for c in self.dim_cols]
        fact_cols = [pdf[f"f_{c}"].tolist() for c in self.fact_cols]
        groups: dict[tuple, tuple[list[int], list[int]]] = {}
        for i, (k, salt) in enumerate(zip(pdf[_KEY].tolist(), pdf[_SALT].tolist())):
            groups.setdefault((self.key_conv(k), int(salt)), ([], []))[0 if tags[i] == 0 else 1].append(i)
        deadline = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
        held, waits, out = None, False, []

        for at, (dim_rows, fact_rows) in groups.items():
            state = self.dims.getValue(at)
            if state is None:
                live, arrival, waiting, attrs = False, None, 0, self.no_attrs
            else:
                live, arrival, waiting, attrs = bool(state[0]), state[1], int(state[2] or 0), tuple(state[3:])
            changed = False

            if dim_rows:
                # The last one counts. Equal arrivals (a change feed's -U/+U pair of one batch): before-image first
                i = sorted(dim_rows, key=lambda i: (arrivals[i] is not None, arrivals[i] or 0,
                                                    _KIND_RANK.get(kinds[i], 1)))[-1]
                # an older version never overwrites a newer one; NULL ranks lowest
                if arrival is None or (arrivals[i] is not None and arrivals[i] >= arrival):
                    live, arrival = kinds[i] not in _RETRACT, arrivals[i]
                    attrs = tuple(conv(col[i]) for conv, col in zip(self.dim_conv, dim_cols))
                    changed = True
            current = attrs if live else None

            if waiting > 0 and held is None:
                held = self._held()
            if current is not None and waiting > 0:
                for k, v in held.pop(at, {}).items():
                    out.append(v[:-1] + current)
                    self.pending.removeKey(k)
                waiting, changed = 0, True

            fact_rows.sort(key=lambda i: (arrivals[i] is not None, arrivals[i] or 0))
            for i in fact_rows:
                values = tuple(conv(col[i]) for conv, col in zip(self.fact_conv, fact_cols))
                # Every version of a fact waits by itself: none replaces another.
                fid = (*at, values[self.id_pos], arrivals[i], kinds[i])
                if kinds[i] in _RETRACT:
                    if waiting > 0:
                        held = self._held() if held is None else held
                        for k, v in list(held.get(at, {}).items()):
                            if k[2] == fid[2] and self._rank(v) <= self._rank(values):
                                del held[at][k]
                                self.pending.removeKey(k)
                                waiting, changed = waiting - 1, True
                    out.append(values + self.no_attrs)
                elif current is not None:
                    out.append(values + current)
                else:
                    self.pending.updateValue(fid, values + (deadline,))
                    if held is not None:
                        held.setdefault(at, {})[fid] = values + (deadline,)
                    waiting, changed, waits = waiting + 1, True, True  # an upper bound; exact after a timer
            if changed:
                self.dims.updateValue(at, (live, arrival, waiting, *attrs))
        if waits:
            self.handle.registerTimer(deadline)
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        expiry, due = expiredTimerInfo.getExpiryTimeInMs(), []
        for at, facts in self._held().items():
            over = [k for k, v in facts.items() if v[-1] is not None and v[-1] <= expiry]
            if not over:
                continue
            for k in over:
                due.append(facts[k][:-1] + self.no_attrs)
                self.pending.removeKey(k)
            state = self.dims.getValue(at)
            if state is not None:
                self.dims.updateValue(at, (state[0], state[1], len(facts) - len(over), *state[3:]))
        if due:
            yield self._frame(due)

    def close(self) -> None:
        pass


def lookup_join_wait(facts: DataFrame, dims: DataFrame, *, fact_key: str, dim_key: str,
                     fact_id: str, cols: Mapping[str, str], wait_seconds: float = 300,
                     salts: int = 4, fact_order: Sequence[str] = (ARRIVAL,)) -> DataFrame:
    """Streaming left lookup of ``dims`` attributes onto ``facts`` with a bounded wait.

    ``facts`` and ``dims`` are streaming change logs (``rowkind``,
    ``arrival``); ``fact_id`` identifies a fact (its primary key). ``cols``
    maps dimension column -> output column. Output: the fact's data columns
    (with ``rowkind`` and ``arrival`` when present) plus the mapped columns.
    ``salts`` splits each key's facts over that many entries of the state.
    ``fact_order`` are the columns that order a fact's versions: a retraction
    withdraws only waiting versions that are not newer than itself.
    """
    fact_cols = [c for c in facts.columns]
    fact_fields = [facts.schema[c] for c in fact_cols]
    dim_fields = [T.StructField(o, dims.schema[c].dataType) for c, o in cols.items()]
    for need in (ROWKIND, ARRIVAL):
        if need not in facts.columns or need not in dims.columns:
            raise ValueError(f"lookup_join_wait needs '{need}' on both streams")
    key_type = facts.schema[fact_key].dataType

    def null(dtype):
        return F.lit(None).cast(dtype)

    n_salts = max(int(salts), 1)
    fact_salt = F.pmod(F.xxhash64(F.col(fact_id)), F.lit(n_salts)).cast("int")
    dim_salt = F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1)))
    f_sel = [F.col(fact_key).cast(key_type).alias(_KEY), fact_salt.alias(_SALT), F.lit(1).alias(_TAG),
             F.col(ROWKIND).alias(ROWKIND), F.col(ARRIVAL).alias(ARRIVAL),
             *[F.col(c).alias(f"f_{c}") for c in fact_cols],
             *[null(f.dataType).alias(f"d_{f.name}") for f in dim_fields]]
    d_sel = [F.col(dim_key).cast(key_type).alias(_KEY), dim_salt.alias(_SALT), F.lit(0).alias(_TAG),
             F.col(ROWKIND).alias(ROWKIND), F.col(ARRIVAL).alias(ARRIVAL),
             *[null(f.dataType).alias(f"f_{f.name}") for f in fact_fields],
             *[F.col(c).alias(f"d_{o}") for c, o in cols.items()]]
    keyed_facts = facts.filter(F.col(fact_key).isNotNull()).select(*f_sel)
    tagged = keyed_facts.unionByName(dims.filter(F.col(dim_key).isNotNull()).select(*d_sel))

    out_schema = T.StructType([*fact_fields, *dim_fields])
    processor = _WaitProcessor(fact_fields, dim_fields, fact_id, int(wait_seconds * 1000), key_type, fact_order)
    tagged = tagged.withColumn(_GROUP, F.pmod(F.xxhash64(_KEY, _SALT), F.lit(STATE_GROUPS)).cast("int"))
    matched = tagged.groupBy(_GROUP).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=out_schema,
        outputMode="Append", timeMode="ProcessingTime")
    # NULL keys never match: they skip the state and come out with NULL attributes
    bypass = facts.filter(F.col(fact_key).isNull()).select(
        *fact_cols, *[null(f.dataType).alias(f.name) for f in dim_fields])
    return matched.unionByName(bypass)
