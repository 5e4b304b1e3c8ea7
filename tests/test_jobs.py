import json

from lakestar import jobs, schemas
from lakestar.operators.query_tables import ask, write_query_tables
from tests.conftest import rows
from tests.test_sources import HEADER, SONG

# artist, firstName, gender, item, lastName, length, level, location, session, song, user
EVENTS = [
    ("Quiet Ferns", "Noor", "M", 4, "S", 321.5, "free", "X", 71,
     "Tin Roof (Night Mix)", 50),
    ("Ida Vale", "Tove", "F", 3, "Lind", 181.2, "free", "X", 64,
     "Rain Over (Short Cut)", 10),
    ("Brass Fence", "Tove", "F", 0, "Lind", 333.7, "free", "X", 64,
     "Ninth Stair", 10),
    ("Cold Orchard", "Tove", "F", 1, "Lind", 411.6, "free", "X", 64, "Harvest 12", 10),
    ("Wren Hollow", "Tove", "F", 2, "Lind", 377.7, "free", "X", 64, "Furlong", 10),
    ("Chalk Line", "Mika", "F", 1, "Okafor", 196.9, "paid", "X", 152,
     "Every Door Twice", 95),
    ("Chalk Line", "Mika", "F", 9, "Okafor", 196.9, "paid", "X", 153,
     "Every Door Twice", 95),
]
COLUMNS = (
    "artist string, firstName string, gender string, itemInSession int, lastName string,"
    " length double, level string, location string, sessionId int, song string, userId int"
)


def test_three_questions_three_tables(spark, tmp_path):
    root = str(tmp_path)
    write_query_tables(spark.createDataFrame(EVENTS, COLUMNS), root)
    one = ask(spark, root, "by_session", session_id=71, item=4)
    assert rows(one, "artist", "song", "length") == [
        ("Quiet Ferns", "Tin Roof (Night Mix)", 321.5)
    ]
    heard = ask(spark, root, "by_user_session", user_id=10, session_id=64)
    assert [(r.item, r.artist, r.first_name, r.last_name) for r in heard.collect()] == [
        (0, "Brass Fence", "Tove", "Lind"),
        (1, "Cold Orchard", "Tove", "Lind"),
        (2, "Wren Hollow", "Tove", "Lind"),
        (3, "Ida Vale", "Tove", "Lind"),
    ]
    who = ask(spark, root, "by_song", song="Every Door Twice")
    assert rows(who, "first_name", "last_name") == [("Mika", "Okafor")]


def raw_files(root):
    (root / "song_data/A/B").mkdir(parents=True)
    (root / "log_data/2018/11").mkdir(parents=True)
    (root / "song_data/A/B/s.json").write_text(json.dumps(SONG))
    play = {"userId": "7", "page": "NextSong", "level": "free", "ts": 1541903636796,
            "sessionId": 1, "itemInSession": 0, "artist": "Chase & Status", "song": "Ten Tonne"}
    other = {**play, "song": "Unknown", "ts": 1541903637796}
    home = {**play, "page": "Home", "ts": 1541903638796}
    (root / "log_data/2018/11/1.json").write_text("\n".join(map(json.dumps, [play, other, home])))


def test_lake_and_warehouse(spark, tmp_path):
    raw_files(tmp_path)
    jobs.event_lake(spark, str(tmp_path), str(tmp_path / "lake"))
    plays = spark.read.parquet(str(tmp_path / "lake/songplays"))
    assert rows(plays, "songplay_id", "song_id") == [(1, "SOGVQGJ12AB017F169"), (2, None)]
    jobs.event_warehouse(spark, str(tmp_path), "wh")
    jobs.event_warehouse(spark, str(tmp_path), "wh")
    counts = {n: spark.table(f"wh.{n}").count() for n in schemas.EVENT_STAR}
    assert counts == {"songplays": 1, "users": 1, "songs": 1, "artists": 1, "time": 3}
    spark.sql("DROP DATABASE wh CASCADE")


def test_event_queries_job(spark, tmp_path):
    line = "A,Logged In,Ann,F,0,Lee,1.5,free,X,PUT,NextSong,1.5E+12,9,Tune,200,1.5E+12,7"
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.csv").write_text(f"{HEADER}\n{line}\n")
    jobs.event_queries(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert rows(ask(spark, str(tmp_path / "out"), "by_song", song="Tune"), "user_id") == [(7,)]
    assert spark.read.csv(str(tmp_path / "out/events"), header=True).count() == 1


def test_event_levels_job(spark, tmp_path):
    raw_files(tmp_path)
    jobs.event_levels(spark, str(tmp_path / "log_data"), str(tmp_path / "state"))
    from lakestar.streaming.levels import current_levels

    assert rows(current_levels(spark, str(tmp_path / "state/levels")), "userId") == [(7,)]
