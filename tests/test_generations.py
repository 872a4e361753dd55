"""Table generations: what a reset checkpoint does to a bronze table, its readers and its registration."""

import pytest

from lakeingest.plans.lab import Lab
from lakeingest.session import delete_path
from lakeingest.spec import DatasetSpec, SpecError
from lakeingest.streaming.catalog import bronze_table_name
from lakeingest.streaming.silver import read_bronze_stream
from lakeingest.streaming.sink import (checkpoint_path, current_generation, data_path, open_generation, read_table,
                                       table_path)

SOURCE = {"type": "files", "format": "json", "path": "{landing}/rows", "schema": "id INT"}
NEW = {"on_checkpoint_reset": "new_generation"}


def _lab(spark, label, **engine):
    lab = Lab(spark, label, **engine)
    return lab, lab.dataset("rows", SOURCE, NEW)


def _ids(frame):
    return sorted(r["id"] for r in frame.select("id").collect())


def test_generations_follow_each_reset(spark):
    lab, ds = _lab(spark, "t_gen", register_tables=True)
    path = table_path(ds, lab.engine)
    for n, (low, high) in enumerate([(0, 3), (3, 5), (5, 6)]):
        lab.land(spark.range(low, high).repartition(1), "rows", f"d{n}", "json")
        result = lab.run(ds)[0]
        assert (result.status, result.rows_ingested) == ("OK", high) and current_generation(spark, path) == n
        assert _ids(read_table(spark, path)) == list(range(high))
        assert _ids(spark.table(bronze_table_name(spark, lab.engine, ds))) == list(range(high))
        assert read_bronze_stream(spark, path).isStreaming
        # A run through the same checkpoint goes on in the same generation.
        assert lab.run(ds)[0].rows_ingested == 0 and current_generation(spark, path) == n
        delete_path(spark, checkpoint_path(ds, lab.engine))
    assert [_ids(read_table(spark, path, generation=g)) for g in (0, 1)] == [[0, 1, 2], [0, 1, 2, 3, 4]]


def test_readers_keep_the_old_generation_until_the_new_one_is_complete(spark):
    lab, ds = _lab(spark, "t_gen_fail")
    path = table_path(ds, lab.engine)
    lab.land(spark.range(2).repartition(1), "rows", "d1", "json")
    lab.run(ds)
    delete_path(spark, checkpoint_path(ds, lab.engine))
    broken = lab.dataset("rows", SOURCE, {**NEW, "derived_columns": {"x": "IF(id < 1, id, CAST(raise_error('no') AS INT))"}})
    assert lab.run(broken)[0].status == "ERROR"
    assert current_generation(spark, path) == 0 and _ids(read_table(spark, path)) == [0, 1]
    # The checkpoint of the failed run goes on with the generation it had begun.
    result = lab.run(ds)[0]
    assert (result.status, result.rows_ingested, current_generation(spark, path)) == ("OK", 2, 1)
    assert _ids(read_table(spark, path)) == [0, 1]


def test_an_abandoned_generation_is_not_written_again(spark):
    lab, ds = _lab(spark, "t_gen_twice")
    path, checkpoint = table_path(ds, lab.engine), checkpoint_path(ds, lab.engine)
    assert open_generation(spark, path, checkpoint, "new_generation") == 0
    delete_path(spark, checkpoint)
    assert open_generation(spark, path, checkpoint, "new_generation") == 1
    assert open_generation(spark, path, checkpoint) == 1
    delete_path(spark, checkpoint)
    assert open_generation(spark, path, checkpoint, "new_generation") == 2
    assert current_generation(spark, path) == 0 and data_path(spark, path) == path


def test_refused_by_default_and_for_a_checkpoint_of_another_table(spark):
    lab, ds = _lab(spark, "t_gen_refused")
    lab.land(spark.range(2).repartition(1), "rows", "d1", "json")
    plain = lab.dataset("rows", SOURCE, {})
    lab.run(plain)
    other = lab.dataset("other", {**SOURCE, "path": "{landing}/rows"}, {})
    lab.run(other)
    taken = {**NEW, "options": {"checkpointLocation": checkpoint_path(other, lab.engine)}}
    foreign = lab.run(lab.dataset("rows", SOURCE, taken))[0]
    delete_path(spark, checkpoint_path(plain, lab.engine))
    reset = lab.run(plain)[0]
    assert [r.status for r in (foreign, reset)] == ["ERROR", "ERROR"]
    assert all("CheckpointMismatchError" in r.error_message for r in (foreign, reset))


def test_unknown_choice_is_an_error_of_the_spec():
    with pytest.raises(SpecError, match="on_checkpoint_reset"):
        DatasetSpec.from_dict({"datasource": "a", "dataset": "b", "source": SOURCE,
                               "sink": {"on_checkpoint_reset": "ignore"}}, "b.json")
