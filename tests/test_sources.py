"""Readers, writers and the scratch folder."""

import gzip

import pytest

from covshare.sources import readers, schemas, sinks
from covshare.sources.scratch import scratch_path, stored


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_western_text_and_declared_types(spark, tmp_path):
    text = (
        "LogRecNo,Provider_Id,FRN,DBAName,HocoNum,StateAbbr,BlockCode,TechCode,"
        "Consumer,MaxAdDown,MaxAdUp,Business,MaxCIRDown,MaxCIRUp\n"
        '1,2,3,"Télé, Inc.",7,AL,10010201001000,70,1,0.768,0.2,0,0,0\n'
    )
    path = write(tmp_path / "filings.csv", text, "latin-1")
    row = readers.read_deployment(spark, path).first()
    assert row["dba_name"] == "Télé, Inc."
    assert (row["block_code"], row["hoco_num"], row["max_down"]) == (10010201001000, 7, 0.768)


def test_pruned_scan(spark, tmp_path):
    path = write(tmp_path / "filings.csv", ",".join(f.split(" ")[0] for f in schemas.DEPLOYMENT.split(", ")) + "\n")
    frame = readers.read_deployment(spark, path).select("hoco_num", "block_code")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<HocoNum:bigint,BlockCode:bigint>" in plan


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(tmp_path / "people.csv", "state,pop2017,hh2016,block_fips,hu2016\nAL,20,7,10010201001000,8\n")
    frame = readers.read_block_population(spark, path)
    assert frame.columns == ["block_code", "gl_pop", "gl_housing_units", "gl_households", "state"]
    assert tuple(frame.first()) == (10010201001000, 20, 8, 7, "AL")
    with pytest.raises(ValueError, match="countyFIPS"):
        readers.read_county_population(spark, write(tmp_path / "c.csv", "county,CountyPop\n1,2\n"))


def test_files_of_a_folder_in_other_orders(spark, tmp_path):
    write(tmp_path / "a.csv", "countyFIPS,CountyPop\n1001,5\n")
    write(tmp_path / "b.csv", "CountyPop,note,countyFIPS\n6,x,1003\n")
    write(tmp_path / "c {1}*.csv", "\nCountyPop,countyFIPS\n7,1005\n")
    write(tmp_path / "empty.csv", "")
    frame = readers.read_county_population(spark, str(tmp_path))
    assert frame.columns == ["county_fips", "county_pop", "note"]
    assert sorted(map(tuple, frame.collect())) == [(1001, 5, None), (1003, 6, "x"), (1005, 7, None)]
    write(tmp_path / "d.csv", "CountyPop,county\n7,1005\n")
    with pytest.raises(ValueError, match="d.csv has no column countyFIPS"):
        readers.read_county_population(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no header"):
        readers.read_county_population(spark, write(tmp_path / "none.csv", "\n"))


def test_unnamed_and_repeated_names(spark, tmp_path):
    text = ",countyFIPS,note,COUNTYFIPS,,CountyPop,note,countyFIPS,Note,note.1\n0,1001,a,9,b,5,c,8,d,e\n"
    frame = readers.read_county_population(spark, write(tmp_path / "t.csv", text))
    assert frame.columns == [
        "county_fips", "county_pop", "Unnamed: 0", "note", "COUNTYFIPS.1", "Unnamed: 4", "note.1", "countyFIPS.2", "Note.2", "note.1.1",
    ]
    assert tuple(frame.first()) == (1001, 5, "0", "a", "9", "b", "c", "8", "d", "e")
    assert frame.select("county_pop").where("county_fips = 1001").first()[0] == 5


def test_marked_quoted_and_packed_headers(spark, tmp_path):
    marked = write(tmp_path / "bom.csv", '\ufeff"countyFIPS","Pop, all",CountyPop\n1001,2,5\n')
    assert readers.read_county_population(spark, marked).columns == ["county_fips", "county_pop", "Pop, all"]
    with gzip.open(tmp_path / "t.csv.gz", "wt") as file:
        file.write(",countyFIPS,CountyPop\n0,1001,5\n")
    assert tuple(readers.read_county_population(spark, str(tmp_path / "t.csv.gz")).first()) == (1001, 5, "0")


def test_payload_files_are_united_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", ",stateFIPS,share,code\n0,1,2.5,7\n")
    write(tmp_path / "b.csv", "code,share,stateFIPS\nx,3,2\n")
    frame = readers.read_payload(spark, str(tmp_path), "state_fips", "stateFIPS")
    assert frame.columns == ["state_fips", "Unnamed: 0", "share", "code"]
    assert sorted(map(tuple, frame.collect())) == [(1, 0.0, 2.5, "7"), (2, None, 3.0, "x")]


def test_names_carry_other_columns(spark, tmp_path):
    path = write(tmp_path / "names.csv", "STATEFP,a.b,COUNTYFP,county_name\n1,x,1,Ay\n")
    assert readers.read_county_names(spark, path).first().asDict() == {
        "state_fp": 1, "county_fp": 1, "county_name": "Ay", "a.b": "x"
    }


def test_payload_keeps_text(spark, tmp_path):
    path = write(tmp_path / "rural.csv", ",stateFIPS,share.2017,note\n0,1,2.5,low\n1,2,,high\n")
    rows = [tuple(r) for r in readers.read_payload(spark, path, "state_fips", "stateFIPS").orderBy("state_fips").collect()]
    assert rows == [(1, 0.0, 2.5, "low"), (2, 1.0, None, "high")]


def test_header_is_replaced(spark, tmp_path):
    path = write(tmp_path / "county.csv", "GEO.id2,a,b\n1001,55000,22000\n")
    frame = readers.read_county_housing(spark, path)
    assert frame.columns == ["county_fips", "population", "housing_units"]
    assert tuple(frame.first()) == (1001, 55000, 22000)


def test_other_delimiter(spark, tmp_path):
    path = write(tmp_path / "t.csv", "k|v\n1|x\n")
    frame = readers.read_table(spark, path, "k INT, v STRING", {"v": "name"}, delimiter="|")
    assert frame.columns == ["k", "name"] and tuple(frame.first()) == (1, "x")


def test_malformed_number_is_an_error(spark, tmp_path):
    path = write(tmp_path / "t.csv", "block_fips,pop2017,hu2016,hh2016\n1,x,1,1\n")
    with pytest.raises(Exception):
        readers.read_block_population(spark, path).collect()


def test_income_behind_a_preamble(spark, tmp_path):
    amounts = '"Poverty Estimate, All Ages",90% CI,Median Household Income'
    text = (
        "Small area estimates\nTable 1\n\n"
        f"Name,County FIPS Code,State FIPS Code,Postal Code,{amounts}\n"
        'Ay,1,1,AL,"7,390","1,2","55,317"\nBee,3,1,AL,21199,1,.\n'
    )
    path = write(tmp_path / "income_c.csv", text)
    got = sorted(tuple(r) for r in readers.read_county_income(spark, path).collect())
    assert got == [(1001, 7390, 55317), (1003, 21199, None)]
    state = write(tmp_path / "income_s.csv", f"t\n\n\nState FIPS Code,Postal Code,{amounts}\n1,AL,10,3,20\n")
    assert tuple(readers.read_state_income(spark, state).first()) == (1, 10, 20)
    nation = write(tmp_path / "income_n.csv", f"t\n\nmerge_level,{amounts}\nnational,30,3,40\n")
    assert tuple(readers.read_national_income(spark, nation).first()) == ("national", 30, 40)
    with pytest.raises(ValueError, match="no header"):
        readers.read_state_income(spark, nation)
    bad = write(tmp_path / "bad.csv", f"State FIPS Code,{amounts}\n1,x,3,20\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_state_income(spark, bad).collect()


def test_sinks_overwrite_and_keep_encoding(spark, tmp_path):
    path = str(tmp_path / "out")
    for name in ("Doña Ana", "Año"):
        frame = spark.createDataFrame([(1, name)], "k INT, name STRING")
        sinks.write_csv(frame, path, encoding=schemas.WESTERN)
    back = readers.read_table(spark, path, "k INT, name STRING", encoding=schemas.WESTERN)
    assert [tuple(r) for r in back.collect()] == [(1, "Año")]
    sinks.write_parquet(frame, str(tmp_path / "pq"), "k")
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 1


def test_report_is_written_under_published_names(spark, tmp_path):
    frame = spark.createDataFrame([(1001, 1, 5)], "county_fips INT, state_fips INT, population INT")
    sinks.write_report(frame, str(tmp_path / "report"))
    back = spark.read.csv(str(tmp_path / "report"), header=True)
    assert back.columns == ["countyFIPS", "stateFIPS", "Population"]


def test_stored_table_reads_back_under_the_shared_folder(spark):
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert path.startswith(folder)
    frame = spark.range(10).selectExpr("id", "id % 3 AS k")
    again = stored(frame, "numbers")
    assert again.schema.simpleString() == frame.schema.simpleString()
    assert again.agg({"id": "sum"}).first()[0] == 45
    assert "Range" not in again._jdf.queryExecution().executedPlan().toString()
