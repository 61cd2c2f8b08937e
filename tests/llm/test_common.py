from pathlib import Path

from sluice.llm.common import scratch, staged
from sluice.llm.simhash import keep_first_rows


def test_what_is_staged_inside_goes_at_the_end(spark, make, prose, tmp_path):
    docs = make([(1, prose(1, 50)), (2, prose(1, 50)), (3, prose(2, 50))])
    with scratch(spark) as folder:
        keep_first_rows(spark, docs).write.parquet(str(tmp_path / "kept"))
        held = Path(folder.removeprefix("file:"))
        assert len([*held.iterdir()]) > 3
        assert not [p for p in held.parent.glob("llm-*") if p != held and p.stat().st_mtime > held.stat().st_mtime]
    assert not held.exists()
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "kept")).collect()) == [1, 3]
    # Outside of it every table has a folder of its own.
    a, b = (staged(spark, docs, "x").inputFiles()[0] for _ in range(2))
    assert a != b
