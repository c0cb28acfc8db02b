from collections import defaultdict

from corpusloom.operators.losses import running_loss
from corpusloom.operators.ranking import with_rank
from corpusloom.operators.sequences import padded_batches
from corpusloom.operators.splits import cap_splits


def test_running_loss_keeps_every_row(spark):
    rows = [
        ("a", 1, "train", 1, 2.0), ("a", 1, "train", 2, 4.0), (None, 1, "train", 1, 3.0), (None, 1, "train", 2, None), ("a", None, "train", 1, 5.0),
        ("a", 1, None, 7, 6.0), ("a", 1, None, None, 8.0), (None, None, None, None, None),
    ]
    log = spark.createDataFrame(rows, "run string, epoch int, split string, batch_num long, loss double")
    for chunk in (1, 2, 1_000):
        found = {tuple(r)[:4]: r.avg_so_far for r in running_loss(log, chunk).collect()}
        groups = defaultdict(list)
        for row in sorted(rows, key=lambda r: (r[3] is not None, r[3] or 0)):
            groups[row[:3]].append(row)
        want = {}
        for group in groups.values():
            for i, row in enumerate(group):
                seen = [r[4] for r in group[: i + 1] if r[4] is not None]
                want[row[:4]] = sum(seen) / len(seen) if seen else None
        assert found == want and len(found) == len(rows)


def test_ranks_of_a_null_group(spark):
    rows = [(i, "train" if i % 3 else None) for i in range(30)]
    found = with_rank(spark.createDataFrame(rows, "doc_id long, split string"), "doc_id", [1], by=["split"]).collect()
    assert sorted(r["rank"] for r in found if r.split is None) == list(range(1, 11))
    assert sorted(r["rank"] for r in found if r.split) == list(range(1, 21))


def test_caps_leave_a_null_split_whole(spark):
    rows = [(i, ["train", "validation", None][i % 3]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, split string")
    kept = cap_splits(docs, "doc_id", {"train": 4, "validation": 2}).collect()
    assert sorted(str(r.split) for r in kept) == ["None"] * 10 + ["train"] * 4 + ["validation"] * 2


def test_batches_of_a_null_split(spark):
    rows = [(i, None if i % 2 else "train", [1, 2], [2, 3]) for i in range(10)]
    found = padded_batches(spark.createDataFrame(rows, "doc_id long, split string, input_ids array<int>, output_ids array<int>"), "doc_id", 2).collect()
    assert sorted(r.doc_id for r in found) == list(range(10))
