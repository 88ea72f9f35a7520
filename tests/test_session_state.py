"""Sessions merged load by load, and from a stream, against one run over all events."""

import random

import pytest
from test_sessions import _events

from sparkmart.operators import session_state, sessions
from sparkmart.streaming import sessions as stream


def sample(seed):
    draw = random.Random(seed)
    rows = []
    for i in range(140):
        second = draw.choice([None, draw.randint(0, 40_000), 1800 * draw.randint(0, 60), 1800 * draw.randint(0, 60) + 1, 86_400 * draw.randint(0, 3)])
        rows.append((f"e{i:03d}", draw.choice(["C1", "C1", "C2", "C3", None]), second, draw.choice(["view", "conversion"])))
    return rows


def as_set(df):
    return sorted(map(str, df.collect()))


def whole(events):
    return sessions.rollup(sessions.assign(events))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_loads_gives_the_sessions_of_one_run(spark, tmp_path, seed):
    rows, draw = sample(seed), random.Random(seed)
    parts = [[], [], []]
    for r in rows:
        draw.choice(parts).append(r)
    events = _events(spark, rows)
    state = session_state.store(spark, f"file://{tmp_path}", events, buckets=4)
    for k, part in enumerate(parts):
        session_state.merge(state, _events(spark, part), str(k))
    assert as_set(session_state.rollup(state)) == as_set(whole(events))
    columns = ["event_id", "session_number", "true_session_id"]
    got = session_state.assign(events, state).select(columns)
    assert as_set(got) == as_set(sessions.assign(events).select(columns))
    # The state after the first load alone, and a load that comes again.
    assert as_set(session_state.rollup(state, state.entries(upto="0"))) == as_set(whole(_events(spark, parts[0])))
    session_state.merge(state, _events(spark, parts[2]), "2")
    assert as_set(session_state.rollup(state)) == as_set(whole(events))


def test_gaps_of_exactly_the_timeout_and_late_joins(spark, tmp_path):
    loads = [[("a", "C1", 0, "x"), ("b", "C1", 3600, "x"), ("f", "C2", 9000, "x")], [("c", "C1", 1800, "x")], [("d", "C1", 5401, "x"), ("e", "C1", 7201, "conversion")]]
    events = _events(spark, sum(loads, []))
    state = session_state.store(spark, f"file://{tmp_path}", events, buckets=4)
    counts = []
    for k, load in enumerate(loads):
        before = state.entries()
        after = session_state.merge(state, _events(spark, load), str(k))
        counts.append(sum(e.rows for e in after.values()))
        other = [b for b in before if all(r.customer_id == "C2" for r in state.read({b: before[b]}).collect())]
        assert k == 0 or all(after[b] == before[b] for b in other)  # buckets without its visitors stay
    assert counts == [3, 2, 3]
    assert as_set(session_state.rollup(state)) == as_set(whole(events))


def test_stream_restarts_from_its_checkpoint(spark, tmp_path):
    rows = sample(5)
    events = _events(spark, rows)
    source, state = f"{tmp_path}/in", session_state.store(spark, f"file://{tmp_path}/state", events, buckets=4)
    arguments = (spark, source, events.schema, state, f"{tmp_path}/checkpoint")
    _events(spark, rows[:60]).coalesce(1).write.mode("append").parquet(source)
    _events(spark, rows[60:90]).coalesce(1).write.mode("append").parquet(source)
    stream.run(*arguments, files_per_batch=1)
    assert len(state.versions()) == 2
    assert as_set(session_state.rollup(state)) == as_set(whole(_events(spark, rows[:90])))
    _events(spark, rows[90:]).coalesce(1).write.mode("append").parquet(source)
    stream.run(*arguments, files_per_batch=1)
    assert len(state.versions()) == 3 and as_set(session_state.rollup(state)) == as_set(whole(events))
    stream.run(*arguments)  # nothing new
    assert as_set(session_state.rollup(state)) == as_set(whole(events))
    # A batch that runs again after its version was committed replaces itself.
    stream.step(state, _events(spark, rows[90:]), state.versions()[-1])
    assert as_set(session_state.rollup(state)) == as_set(whole(events))


def test_late_rows_are_kept_apart(spark, tmp_path):
    first, second = [("a", "C1", 50_000, "x")], [("b", "C1", 40_000, "x"), ("c", "C1", 49_000, "x"), ("d", "C2", None, "x")]
    events = _events(spark, first + second)
    state = session_state.store(spark, f"file://{tmp_path}", events, buckets=4)
    stream.step(state, _events(spark, first), stream.version_of(0), lateness_s=3600)
    stream.step(state, _events(spark, second), stream.version_of(1), lateness_s=3600)
    late = stream.late_rows(spark, state, events.schema).collect()
    assert [(r.event_id, r.version) for r in late] == [("b", stream.version_of(1))]
    assert as_set(session_state.rollup(state)) == as_set(whole(_events(spark, first + second[1:])))
