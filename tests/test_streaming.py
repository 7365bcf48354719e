"""Incremental per-game distance equals the batch job."""

import random

import pytest

from conftest import rows
from strideframe import schemas
from strideframe.plans.distance import distance_per_entity
from strideframe.sources.readers import read_table, scale_columns
from strideframe.streaming.incremental import distance_from_partials, start_distance_stream


def test_stream_matches_batch(spark, tmp_path):
    rnd = random.Random(2)
    mdir = tmp_path / "moments"
    mdir.mkdir()
    header = ",".join(f.name for f in schemas.MOMENTS.fields)
    for g in range(3):
        lines = []
        for p in range(-1, 4):
            c = 720.0
            for _ in range(60):
                c = round(c - rnd.choice([0.04, 0.04, 0.08, 0.6]), 2)
                lines.append(f"{g},1,1,{c},10,1,{p},{rnd.uniform(0, 94):.3f},{rnd.uniform(0, 50):.3f},1")
        (mdir / f"game{g}.csv").write_text(header + "\n" + "\n".join(lines) + "\n")
    minutes = spark.createDataFrame([(p, 600.0) for p in range(4)], "player_id long, sec double")
    parts = str(tmp_path / "partials")
    q = start_distance_stream(spark, str(mdir), parts, checkpoint=str(tmp_path / "ckpt"), max_files_per_trigger=1)
    q.awaitTermination(120)
    streamed = distance_from_partials(spark, parts, minutes)
    m = scale_columns(read_table(spark, str(mdir) + "/*.csv", schemas.MOMENTS), ["x_loc", "y_loc", "radius"])
    batch = distance_per_entity(m, minutes)
    assert rows(streamed) == rows(batch)


def test_columns_in_another_order_stop_the_stream(spark, tmp_path):
    (tmp_path / "moments").mkdir()
    names = [f.name for f in schemas.MOMENTS.fields]
    names.insert(0, names.pop(names.index("player_id")))
    (tmp_path / "moments" / "game.csv").write_text(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    q = start_distance_stream(spark, str(tmp_path / "moments"), str(tmp_path / "partials"), str(tmp_path / "ckpt"))
    with pytest.raises(Exception, match="header"):
        q.awaitTermination(120)
