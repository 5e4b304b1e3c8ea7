import json

from lakestar.streaming.levels import current_levels, follow_logs
from tests.conftest import rows


def write_day(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(line) for line in lines))


def play(user, level, ts, page="NextSong"):
    return {"userId": user, "level": level, "ts": ts, "page": page, "sessionId": 1,
            "itemInSession": 0, "firstName": "Ann", "lastName": "Lee", "gender": "F"}


def run(spark, tmp_path):
    source, root, check = (str(tmp_path / n) for n in ("logs", "levels", "check"))
    query = follow_logs(spark, source, root, check, files_per_batch=1)
    query.awaitTermination(120)
    assert query.exception() is None
    return current_levels(spark, root)


def test_late_files_never_bring_back_old_levels(spark, tmp_path):
    logs = tmp_path / "logs"
    write_day(logs, "2.json", [play("1", "paid", 20), play("2", "free", 21), play("", "x", 22)])
    assert rows(run(spark, tmp_path), "userId", "level") == [(1, "paid"), (2, "free")]
    write_day(logs, "1.json", [play("1", "free", 10), play("3", "free", 11)])
    write_day(logs, "3.json", [play("2", "paid", 30), play("2", "gold", 40, page="Home")])
    assert rows(run(spark, tmp_path), "userId", "level") == [
        (1, "paid"),
        (2, "paid"),
        (3, "free"),
    ]


def test_running_again_without_new_files_changes_nothing(spark, tmp_path):
    write_day(tmp_path / "logs", "1.json", [play("1", "free", 10)])
    first = rows(run(spark, tmp_path))
    assert rows(run(spark, tmp_path)) == first
