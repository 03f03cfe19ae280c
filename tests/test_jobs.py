from lendspark.__main__ import main, parser
from lendspark.operators import split
from tests.test_stream import drain, world, write_records  # noqa: F401


def test_split_job(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,target\n" + "".join(f"{i},{i % 2}\n" for i in range(40)))
    main(["split", "--input", str(tmp_path / "in.csv"), "--out", str(tmp_path / "out"), "--label", "target", "--ids", "id", "--ratio", "0.5"])
    facts = split.read_split_metadata(spark, str(tmp_path / "out")).first()
    assert (facts.train_rows, facts.simulation_rows, facts.random_state) == (20, 20, 42)


def test_training_job(spark, world, tmp_path, capsys):  # noqa: F811
    folder, bki, balance, tables = world
    bki.write.parquet(str(tmp_path / "plain-bki"))
    balance.write.parquet(str(tmp_path / "balance"))
    main(["layout", "--input", str(tmp_path / "plain-bki"), "--out", str(tmp_path / "bki"), "--key", "reco_id_curr", "--buckets", "4"])
    write_records(spark, folder, [("c", 3), ("c", 1)], 40)
    drain(spark, world)
    main([
        "training", "--lake", tables.applications.removesuffix("/applications"),
        "--bki", str(tmp_path / "bki"), "--balance", str(tmp_path / "balance"),
        "--jdbc-url", "jdbc:postgresql://db.invalid/x", "--out", str(tmp_path / "training"),
    ])
    target = capsys.readouterr().out.strip().splitlines()[-1]
    rows = spark.read.parquet(target)
    assert len(rows.columns) == 122 + 4  # no prior loans: the database is away
    # Application 1 was deleted and created again, with its two credits; one event has no key.
    assert sorted(map(str, (r.reco_id_curr for r in rows.collect()))) == ["1", "1", "2", "3", "None"]
    lake = tables.applications.removesuffix("/applications")
    main(["compact", "--lake", lake])
    assert capsys.readouterr().out.strip().splitlines()[-1] == "1"


def test_ingest_options():
    args = parser().parse_args(
        "ingest --servers a:1 --topic t --bki b --balance c --lake l".split()
    )
    assert args.every == "120 seconds"
    assert (args.starting_offsets, args.max_offsets, args.fail_on_data_loss) == ("latest", 50, "true")
