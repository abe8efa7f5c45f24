import duckdb
import pytest

from passledger import queries
from passledger.plans import sections
from tests.oracle import same


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert same(spark, sf_dir, queries.queries()[name], queries.oracle_sql()[name])


def test_every_query_has_its_sql():
    assert set(queries.queries()) == set(queries.oracle_sql())


@pytest.mark.parametrize("name", ["section_duplicates", "section_ordering", "tile_features"])
def test_tiles_that_share_an_id_give_one_row(spark, sf_dir, tmp_path, name):
    """Tile numbers of six digits lose the last one in the id, so that a tile has several outlines."""
    con = duckdb.connect()
    con.execute(f"copy (select * replace (c_custkey + i as c_custkey) from '{sf_dir}/customer.parquet', (values (90000), (900000)) t(i)) to '{tmp_path}/customer.parquet' (format parquet)")
    con.execute(f"copy (select * replace (o_orderkey + i as o_orderkey, o_custkey + i as o_custkey) from '{sf_dir}/orders.parquet', (values (90000), (900000)) t(i)) to '{tmp_path}/orders.parquet' (format parquet)")
    (tmp_path / "lineitem.parquet").symlink_to(f"{sf_dir}/lineitem.parquet")
    assert same(spark, str(tmp_path), queries.queries()[name], queries.oracle_sql()[name])


@pytest.mark.parametrize("name", ["section_duplicates", "section_ordering"])
def test_sections_with_more_failures_than_they_show(spark, sf_dir, tmp_path, monkeypatch, name):
    """As on large tables: the failures shown end among tiles that share an id."""
    *others, most = sections.build_section.__defaults__
    sql = queries.oracle_sql()[name]
    assert most == 50_000 and sql.count("50000") == 3
    con = duckdb.connect()
    con.execute(f"copy (select * replace (c_custkey + i as c_custkey) from '{sf_dir}/customer.parquet', (values (40000), (400000), (400160)) t(i)) to '{tmp_path}/customer.parquet' (format parquet)")
    con.execute(f"copy (select * replace (o_orderkey + i as o_orderkey, o_custkey + i as o_custkey) from '{sf_dir}/orders.parquet', (values (40000), (400000), (400160)) t(i)) to '{tmp_path}/orders.parquet' (format parquet)")
    (tmp_path / "lineitem.parquet").symlink_to(f"{sf_dir}/lineitem.parquet")
    monkeypatch.setattr(sections.build_section, "__defaults__", (*others, 15))
    assert queries.queries()[name](spark, str(tmp_path)).first()["truncated"]
    assert same(spark, str(tmp_path), queries.queries()[name], sql.replace("50000", "15"))


def test_all_granules_are_searched_for_polarization_issues(spark, sf_dir):
    """Against plain Python, without the cut at the end of 1997 of `polarization_issues`."""
    import hashlib
    from itertools import groupby

    from passledger import fixtures as fx

    rows = sorted((r.n, r.acq_dt.year > 1996, r.opera_id, r.jpl_burst_id, r.polarizations) for r in fx.inputs(spark, sf_dir).collect())
    assert max(r.acq_dt.year for r in fx.inputs(spark, sf_dir).select("acq_dt").collect()) > 1997
    want = {}
    for n, own in groupby(rows, lambda r: r[0]):
        own = list(own)
        last = {burst: pol for _, post, _, burst, pol in own if post}
        short = lambda i: "_".join(i.split("_")[:5])
        single = [f"{short(i)}={pol}" for _, _, i, _, pol in own if pol not in ("VV+VH", "HH+HV")]
        unlike = [f"{short(i)}={pol} vs post-image {last[burst]}" for _, post, i, burst, pol in own if not post and last.get(burst, pol) != pol]
        want[f"P{n}"] = tuple(hashlib.md5(";".join(x).encode()).hexdigest() for x in (single, unlike))
    got = queries.queries()["polarization_issues_all"](spark, sf_dir).collect()
    assert {r.product: (r.single_md5, r.mismatch_md5) for r in got} == want
