from __future__ import annotations

import json

import pytest
import run


@pytest.fixture
def files(tmp_path):
    (tmp_path / "rental.csv").write_text("rental_id,customer_id,rental_date\n1,5,2007-02-14 21:21:59\n")
    (tmp_path / "payment.csv").write_text("rental_id,payment_date,amount\n1,2007-02-15,5.99\n")
    (tmp_path / "customer.csv").write_text("customer_id,store_id\n5,1\n")
    return tmp_path


def test_mart(spark, files):
    paths = [f"--{role}={files / role}.csv" for role in ("rental", "payment", "customer")]
    run.main(["mart", *paths, f"--target={files / 'mart'}"])
    run.main(["mart", *paths, f"--target={files / 'mart'}"])
    assert spark.read.parquet(str(files / "mart")).count() == 1
    run.main(["mart", *paths, f"--target={files / 'mart'}", "--append"])
    assert spark.read.parquet(str(files / "mart")).count() == 2


def test_arrivals(spark, files, capsys):
    inbox = files / "inbox"
    inbox.mkdir()
    command = ["arrivals", f"--inbox={inbox}", f"--state={files / 'state'}", f"--root={files}",
               f"--target={files / 'mart'}"]
    command += [f"--route={role}={role}" for role in ("rental", "payment", "customer")]
    run.main(command)
    assert "nothing built" in capsys.readouterr().out
    records = [{"eventName": "ObjectCreated:Put", "s3": {"object": {"key": f"{role}.csv"}}} for role in ("rental", "payment", "customer")]
    line = json.dumps({"seq": 1, "body": json.dumps({"Records": records})})
    (inbox / "1.json").write_text(line + "\n{broken line\n")
    run.main(command)
    assert "mart built" in capsys.readouterr().out
    assert spark.read.parquet(str(files / "mart")).count() == 1
    assert [r["_corrupt_record"] for r in spark.read.parquet(str(files / "state/malformed")).collect()] == ["{broken line"]


def test_rentals(spark, files):
    paths = [f"--{role}={files / role}.csv" for role in ("rental", "payment", "customer")]
    run.main(["rentals", *paths, f"--target={files / 'profile'}"])
    assert tuple(spark.read.parquet(str(files / "profile/counts")).first()) == (1, 1, 1)
    assert spark.read.parquet(str(files / "profile/schema")).count() == 8
    assert str(spark.read.parquet(str(files / "profile/latest")).first()["rental_date"]) == "2007-02-14"


def test_pivot(spark, tmp_path):
    spark.createDataFrame([("a", 1, "x"), ("a", 3, "y")], "k string, n int, c string").write.parquet(str(tmp_path / "in"))
    run.main(["pivot", f"--source={tmp_path / 'in'}", "--key=k", "--column=c", "--value=n", f"--target={tmp_path / 'out'}"])
    assert [json.loads(json.loads(r.value)[0]) for r in spark.read.text(str(tmp_path / "out/lines")).collect()] == [
        {"k": "a", "x": 1, "y": 3}
    ]


def test_wait(spark, tmp_path):
    (tmp_path / "inbox").mkdir()
    lines = [{"batch": "b", "source": s, "ts": "2024-01-01T00:00:00"} for s in ("p", "q")]
    (tmp_path / "inbox/1.json").write_text("\n".join(map(json.dumps, lines)))
    run.main(["wait", f"--inbox={tmp_path / 'inbox'}", f"--state={tmp_path / 's'}", f"--target={tmp_path / 't'}",
              "--awaited=p", "--awaited=q"])
    assert spark.read.parquet(str(tmp_path / "t/opened")).count() == 1
    assert spark.read.parquet(str(tmp_path / "t/missing")).count() == 0


def test_profile(spark, capsys, tmp_path):
    spark.range(3).write.option("path", str(tmp_path / "t")).saveAsTable("run_profile_test")
    try:
        run.main(["profile", "--table=default.run_profile_test"])
    finally:
        spark.sql("drop table run_profile_test")
    assert "bigint" in capsys.readouterr().out
