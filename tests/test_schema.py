from claimloom.operators.rows import contract_select, sort_contract
from claimloom.schema import CROSSWALKS, RAW_FEEDS, TABLES

# How many columns each table has.
COLUMNS = {
    "enrollment": 8, "demographic": 9, "dispensing": 7, "encounter": 11, "diagnosis": 10,
    "procedure": 8, "death": 5, "provider": 3, "facility": 2,
}


def test_an_empty_source_of_each_table_has_its_full_contract(spark):
    for name, count in COLUMNS.items():
        spec = TABLES[name]
        table = sort_contract(contract_select(spark.createDataFrame([], "samplenum int"), spec), spec)
        assert len(table.columns) == count and table.count() == 0
        assert [f.dataType for f in table.schema] == [f.dataType for f in spec.struct(samplenum=False)]
    assert set(COLUMNS) == set(TABLES)


def test_rekeyed_ids_have_a_crosswalk_and_the_provider_of_a_dispensing_stays():
    rekeyed = {c for t in TABLES.values() for c in t.rekeyed}
    assert rekeyed == set(CROSSWALKS) and {c.source_table for c in CROSSWALKS.values()} <= set(TABLES)
    assert list(TABLES["dispensing"].rekeyed) == ["PatID"]


def test_raw_feeds_are_declared(spark):
    for ddl in RAW_FEEDS.values():
        assert "DESYNPUF_ID" in spark.createDataFrame([], ddl).columns
