"""The processor of the bounded wait over a state group that holds many keys."""

import pandas as pd
from pyspark.sql import types as T

from carelake.streaming import wait


class _Map(dict):
    def getValue(self, key):
        return self.get(tuple(key))

    def updateValue(self, key, value):
        self[tuple(key)] = tuple(value)

    def removeKey(self, key):
        del self[tuple(key)]

    def iterator(self):
        return iter(list(self.items()))


class _Handle:
    def __init__(self):
        self.maps, self.timers = {}, []

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, _Map())

    def registerTimer(self, at):
        self.timers.append(at)


class _Now:
    def __init__(self, ms):
        self.getCurrentProcessingTimeInMs = self.getExpiryTimeInMs = lambda: ms


def _run(processor, now, *rows):
    """``rows``: tag (0: dimension), key, kind, arrival, fact id, attribute."""
    data = [{"lk_key": k, "lk_salt": 0, "lk_tag": t, "rowkind": kind, "arrival": a, "f_id": i, "f_rowkind": kind, "f_arrival": a,
             "d_name": name} for t, k, kind, a, i, name in rows]
    out = list(processor.handleInputRows((0,), iter([pd.DataFrame(data)]), _Now(now)))
    assert len(out) <= 1  # one call and one frame, however many keys the group holds
    return sorted(map(tuple, out[0][["id", "rowkind", "name"]].astype(object).where(out[0].notna(), None).values)) if out else []


def test_keys_of_a_group_do_not_mix():
    s, n = T.StringType(), T.LongType()
    fields = [T.StructField("id", s), T.StructField("rowkind", s), T.StructField("arrival", n)]
    p, handle = wait._WaitProcessor(fields, [T.StructField("name", s)], "id", 1000, n), _Handle()
    p.init(handle)
    assert _run(p, 0, (0, 1, "+I", 5, None, "A"), (0, 1, "+I", 3, None, "old"), (0, 2, "-D", 4, None, "B"),
                (1, 1, "+I", 1, "f1", None), (1, 2, "+I", 2, "f2", None), (1, 3, "+I", 3, "f3", None),
                (1, 3, "+I", 4, "f4", None), (1, 3, "-D", 5, "f4", None)) == [("f1", "+I", "A"), ("f4", "-D", None)]
    assert handle.timers == [1000] and {k[2] for k in handle.maps["pending"]} == {"f2", "f3"}
    assert _run(p, 500, (0, 2, "+I", 3, None, "late"), (1, 4, "+I", 6, "f5", None)) == []       # older than the delete
    assert _run(p, 600, (0, 2, "+I", 9, None, "C"), (0, 1, "-D", 9, None, "A"), (1, 1, "+I", 7, "f6", None)) == [("f2", "+I", "C")]
    timed = list(p.handleExpiredTimer((0,), _Now(1000), _Now(1000)))
    assert [tuple(r) for r in timed[0][["id", "name"]].values] == [("f3", None)]
    assert {k[2] for k in handle.maps["pending"]} == {"f5", "f6"} and handle.maps["dims"][(3, 0)][2] == 0
    assert _run(p, 1100, (0, 4, "+I", 1, None, "D")) == [("f5", "+I", "D")]
    assert list(p.handleExpiredTimer((0,), _Now(1500), _Now(1500))) == []                       # f5 is out already
    assert [r[0] for r in _run(p, 1550, (0, 1, "+I", 10, None, "E"))] == ["f6"] and not handle.maps["pending"]
