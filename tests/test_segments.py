"""Topics by records: limits, offsets, commits and replays."""

import os

import pytest

from tradelens.sources.segments import Consumer, SegmentTopic


def records(spark, n, start=0, key=None):
    return spark.createDataFrame([(key or f"k{i % 7}", f'{{"a": {i}}}') for i in range(start, start + n)],
                                 "key string, value string")


def values(frame):
    return sorted(r.value for r in frame.collect())


def test_exhausted_before_the_limit_is_finished(spark, tmp):
    topic = SegmentTopic(spark, tmp)
    assert topic.publish(records(spark, 2)) == 2
    finished, got = Consumer(topic, "g").poll(10)
    assert finished is True and values(got) == ['{"a": 0}', '{"a": 1}']


def test_a_full_buffer_is_not_finished(spark, tmp):
    topic = SegmentTopic(spark, tmp)
    topic.publish(records(spark, 3))
    c = Consumer(topic, "g")
    poll = c.poll(2)
    assert poll.finished is False and poll.records.count() == 2
    c.commit(poll)
    poll = c.poll(2)
    assert poll.finished is True and poll.records.count() == 1
    c.commit(poll)
    assert tuple(c.poll(2))[0] is True and c.poll(2).size == 0
    # as many records as the limit fill the buffer: not finished yet
    topic.publish(records(spark, 2))
    assert c.poll(2).finished is False


@pytest.mark.parametrize("limit", [1, 7, 40])
def test_every_record_once_with_dense_offsets(spark, tmp, limit):
    topic = SegmentTopic(spark, tmp, partitions=3)
    # a third of all records has one key; small segments
    for i in range(2):
        topic.publish(records(spark, 20, 100 * i).union(records(spark, 10, 100 * i + 50, "hot")),
                      segment_rows=4)
    seen, sizes = [], []
    c = Consumer(topic, "g")

    def sink(batch, number):
        rows = batch.collect()
        sizes.append(len(rows))
        seen.extend((r.partition, r.offset, r.value) for r in rows)

    if limit > 1:
        c.drain(sink, limit)
    else:
        for _ in range(6):
            poll = c.poll(limit)
            sink(poll.records, poll.batch)
            c.commit(poll)
        c.drain(sink, 25)
        assert sizes[:6] == [1] * 6
    assert max(sizes) <= max(limit, 25 if limit == 1 else 0)
    assert len({v for *_, v in seen}) == len(seen) == 60
    for p, end in topic.ends().items():
        assert sorted(o for q, o, _ in seen if q == p) == list(range(end))
    assert c.committed() == topic.ends()


def test_a_failed_sink_replays_exactly_the_uncommitted_records(spark, tmp):
    topic = SegmentTopic(spark, tmp)
    topic.publish(records(spark, 30))
    out = {}

    def sink(batch, number):
        out[number] = values(batch)
        if number == 1 and len(out) == 2 and not failed:
            failed.append(1)
            raise RuntimeError("sink died")

    failed = []
    with pytest.raises(RuntimeError):
        Consumer(topic, "g").drain(sink, 8)
    died = out[1]
    topic.publish(records(spark, 5, 500))             # more arrives before the restart
    poll = Consumer(topic, "g").poll(100)             # with another limit, too
    assert poll.batch == 1 and values(poll.records) == died
    Consumer(topic, "g").drain(sink, 8)
    assert out[1] == died
    everything = sorted(v for rows in out.values() for v in rows)
    assert everything == sorted([f'{{"a": {i}}}' for i in range(30)] + [f'{{"a": {i}}}' for i in
                                                                       range(500, 505)])


def test_groups_are_apart_and_commits_are_checked(spark, tmp):
    topic = SegmentTopic(spark, tmp)
    topic.publish(records(spark, 4))
    a, b = Consumer(topic, "a"), Consumer(topic, "b")
    poll = a.poll(4)
    a.commit(poll)
    with pytest.raises(ValueError):
        a.commit(poll)
    assert b.committed() == {} and b.poll(10).size == 4


def test_a_dead_publish_is_not_seen(spark, tmp, monkeypatch):
    from tradelens.sources import segments
    topic = SegmentTopic(spark, tmp)
    topic.publish(records(spark, 4))
    with monkeypatch.context() as m:
        m.setattr(segments, "write_small", lambda *a: (_ for _ in ()).throw(OSError()))
        with pytest.raises(OSError):
            topic.publish(records(spark, 9, 50))
    assert sum(topic.ends().values()) == 4
    topic.publish(records(spark, 3, 90))
    assert Consumer(topic, "g").poll(100).records.count() == 7


def test_an_empty_topic(spark, tmp):
    topic = SegmentTopic(spark, os.path.join(tmp, "none"))
    finished, got = Consumer(topic, "g").poll(5)
    assert finished is True and got.count() == 0
    assert topic.publish(records(spark, 1).limit(0)) == 0
    assert Consumer(topic, "g").drain(lambda *_: None, 5) == 0
