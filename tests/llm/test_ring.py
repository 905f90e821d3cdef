import random
import zlib

from tidemark.llm import ring


def test_rows_and_slots(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    rows = ring.shard_rows(docs, 16).collect()
    assert sorted(row.doc_id for row in rows) == sorted(texts)
    slots = {}
    for row in rows:
        assert (row.size, row.text_crc32) == (len(texts[row.doc_id].encode()) + 1, zlib.crc32(texts[row.doc_id].encode()))
        slots.setdefault(row.shard, []).append(row.slot)
    assert len(slots) == 16 and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    again = ring.shard_rows(docs.repartition(5), 16).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_equal_texts_stay_together_while_there_is_room(spark):
    docs = spark.createDataFrame([(i, f"text {i // 3}") for i in range(3000)], "doc_id long, text string")
    shards = {}
    for row in ring.shard_rows(docs, 4).collect():
        shards.setdefault(row.doc_id // 3, set()).add(row.shard)
    assert sum(len(own) > 1 for own in shards.values()) < 200


def brute_assign(counts, shards):
    """Row by row: each goes to the first shard clockwise that has room."""
    nodes = ring.ring_nodes(shards)
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    placed = {}
    for place, piece in sorted(counts, key=lambda key: (key[1], key[0])):
        start = next((i for i, (at, _) in enumerate(nodes) if at >= place), 0)
        for _ in range(counts[place, piece]):
            i = start
            while not room[nodes[i % len(nodes)][1]]:
                i += 1
            shard = nodes[i % len(nodes)][1]
            room[shard] -= 1
            placed[place, piece, shard] = placed.get((place, piece, shard), 0) + 1
    return placed


def test_assignment_equals_brute_force():
    random.seed(2)
    for shards in (1, 2, 5, 16):
        counts = {(random.randrange(ring.PLACES), random.randrange(ring.SLICES)): random.randint(1, 9) for _ in range(200)}
        counts[7, 3] = 300
        got = {}
        for place, piece, first, last, shard, _ in ring.assign(counts, shards):
            got[place, piece, shard] = got.get((place, piece, shard), 0) + last - first + 1
        assert got == brute_assign(counts, shards)


def test_one_more_shard_moves_few_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(8000)], "doc_id long, text string")
    before, after = ({row.doc_id: row.shard for row in ring.shard_rows(docs, n).collect()} for n in (16, 17))
    moved = sum(after[i] != shard and after[i] != 16 for i, shard in before.items())
    assert moved < 0.2 * len(before)  # a hash modulo the number of shards would move nearly all


def test_odd_documents(spark, odd_documents):
    rows = ring.shard_rows(odd_documents, 4).collect()
    assert len(rows) == odd_documents.count()
    assert len({(row.shard, row.slot) for row in rows}) == len(rows)
    assert sum(row.size == 1 and row.text_crc32 == 0 for row in rows) == 4
    assert ring.shard_rows(odd_documents.limit(0)).count() == 0
