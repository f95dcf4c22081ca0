import __spark_entry__ as entry
from conftest import FOLDER
from registered.words import FLAGS


def test_every_flag_is_set_and_not_set(spark):
    row = entry.queries()["word_flag_counts"](spark, FOLDER.replace("sf0.001", "sf0.01")).first()
    assert all(0 < row[name] < row.texts for name in FLAGS)


def test_every_tag_is_found_and_missed(spark):
    rows = entry.queries()["word_coverage"](spark, FOLDER).collect()
    assert len(rows) == 7 and all(r.tagged and r.untagged for r in rows)
