import gzip
import json
from datetime import datetime
from decimal import Decimal

import pytest

from lakestar import schemas
from lakestar.sources import events, files
from tests.conftest import rows

SONG = {
    "num_songs": 1, "artist_id": "AR62SOJ1187FB47BB5", "artist_latitude": None,
    "artist_longitude": None, "artist_location": "", "artist_name": "Chase & Status",
    "song_id": "SOGVQGJ12AB017F169", "title": "Ten Tonne", "duration": 337.68444, "year": 2005,
}
HEADER = (
    "artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,"
    "registration,sessionId,song,status,ts,userId"
)


def test_json_by_glob_and_by_tree(spark, tmp_path):
    for folder, song_id in (("A/A/A", "S1"), ("A/B/C", "S2")):
        (tmp_path / folder).mkdir(parents=True)
        text = json.dumps({**SONG, "song_id": song_id})
        (tmp_path / folder / f"{song_id}.json").write_text(text)
    (tmp_path / "A/A/A/readme.txt").write_text("not json")
    by_glob = files.read_json(spark, f"{tmp_path}/*/*/*/*.json", schemas.SONGS_RAW)
    by_tree = files.read_json(spark, str(tmp_path), schemas.SONGS_RAW, recursive=True)
    expected = [("S1", Decimal("337.68444")), ("S2", Decimal("337.68444"))]
    assert rows(by_glob, "song_id", "duration") == expected
    assert rows(by_tree, "song_id", "duration") == expected


def test_json_lines_and_bad_line(spark, tmp_path):
    path = tmp_path / "log.json"
    path.write_text('{"userId": "7", "ts": 1541903636796}\n{"userId": ""}\n')
    log = files.read_json(spark, str(path), schemas.LOG_RAW)
    assert rows(log, "userId", "ts") == [("", None), ("7", 1541903636796)]
    path.write_text("{broken\n")
    with pytest.raises(Exception):
        files.read_json(spark, str(path), schemas.LOG_RAW, mode="FAILFAST").collect()


def test_json_mapped_with_epoch_millis(spark, tmp_path):
    path = tmp_path / "log.json"
    path.write_text('{"userId": "7", "ts": 1541903636796}\n')
    mapping = {"user_id": "userId", "start_time": "ts"}
    df = files.read_json_mapped(spark, str(path), schemas.LOG_RAW, mapping, ["start_time"])
    text = df.selectExpr("user_id", "cast(start_time as string)")
    assert rows(text) == [("7", "2018-11-11 02:33:56.796")]


def test_consolidate_daily_csv_files(spark, tmp_path):
    played = (
        'Faithless,Logged In,Benjamin,M,4,"Smith, Jr",495.3073,free,"Lake, FL",PUT,NextSong,'
        "1.54E+12,338,Music Matters (Mark Knight Dub),200,1.54181E+12,50"
    )
    home = ",Logged In,Ann,F,0,Lee,,free,X,GET,Home,1.54E+12,339,,200,1.54181E+12,51"
    (tmp_path / "2018-11-01-events.csv").write_text(f"{HEADER}\n{played}\n")
    (tmp_path / "2018-11-02-events.csv").write_text(f"{HEADER}\n{home}\n")
    df = events.consolidate_event_files(spark, str(tmp_path))
    assert df.columns == events.CONSOLIDATED_COLUMNS
    assert rows(df, "artist", "lastName", "length", "sessionId", "userId") == [
        ("Faithless", "Smith, Jr", 495.3073, 338, 50)
    ]


def test_blank_user_ids_are_dropped(spark):
    log = spark.createDataFrame([("7",), ("",), (" ",), (None,)], "userId string")
    assert rows(events.with_user_id(log)) == [(7,)]


def test_headerless_csv_with_array(spark, tmp_path):
    line = 'A1,1998-03-01,5,3,2,P1,"A, title",10,Book,Fiction,Novel,"{X1,X2}"\n'
    empty = "A2,1998-03-02,4,0,0,P2,Other,11,Book,Fiction,Novel,{}\n"
    (tmp_path / "reviews.csv").write_text(line + empty)
    df = files.read_reviews(spark, str(tmp_path), schemas.REVIEWS)
    assert rows(df, "customer_id", "similar_product_ids") == [
        ("A1", ["X1", "X2"]),
        ("A2", []),
    ]


def test_gzip_parts_and_single_file(spark, tmp_path):
    header = "id;sporting_event_id;sport_location_id;seat_level;seat_section;seat_row;seat;" \
             "ticketholder_id;ticket_price\n"
    body = "".join(f"{i};1;2;3;A;B;{i};;9.50\n" for i in range(20))
    single = tmp_path / "full.csv.gz"
    single.write_bytes(gzip.compress((header + body).encode()))
    parts = tmp_path / "parts"
    parts.mkdir()
    for part in range(2):
        lines = "".join(f"{i};1;2;3;A;B;{i};;9.50\n" for i in range(part * 10, part * 10 + 10))
        (parts / f"part{part}.csv.gz").write_bytes(gzip.compress((header + lines).encode()))
    a = files.read_gzip_file(spark, str(single), schemas.TICKETS, partitions=3)
    b = files.read_csv(spark, str(parts), schemas.TICKETS, sep=";")
    assert a.rdd.getNumPartitions() == 3
    assert rows(a) == rows(b) and a.count() == 20
    assert a.first()["ticket_price"] == Decimal("9.50")


def test_star_files(spark, tmp_path):
    for name, line in (("part", "1|n|m|c|b|red|t|5|box"), ("supplier", "1|n|a|city|na|re|p")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "0.gz").write_bytes(gzip.compress((line + "\n").encode()))
    wanted = {k: schemas.STAR_BENCHMARK[k] for k in ("part", "supplier")}
    tables = files.read_star_files(spark, str(tmp_path), wanted)
    assert tables["part"].first()["p_size"] == 5
    assert tables["supplier"].first()["s_region"] == "re"


def test_text_parquet_and_rows(spark, tmp_path):
    (tmp_path / "songs.txt").write_text("salt road\nsix lanterns\nsalt road\n")
    lines = files.read_lines(spark, str(tmp_path / "songs.txt"))
    counted = lines.groupBy("value").count()
    assert rows(counted) == [("salt road", 2), ("six lanterns", 1)]
    df = files.from_rows(spark, [(1, 2018), (2, 2019)], "id int, year int")
    df.write.partitionBy("year").parquet(str(tmp_path / "t"))
    assert rows(files.read_parquet(spark, str(tmp_path / "t"))) == [(1, 2018), (2, 2019)]
    one = files.read_parquet(spark, str(tmp_path / "t/year=2019"), str(tmp_path / "t"))
    assert rows(one) == [(2, 2019)]


def test_timestamps_keep_millis(spark):
    from pyspark.sql import functions as F

    from lakestar.functions.calendar import from_epoch_millis

    df = spark.range(1).select(from_epoch_millis(F.lit(1541903636796)).alias("t"))
    assert df.first()["t"] == datetime.fromtimestamp(1541903636.796)
