"""Tables through release files and loader, against the query's SQL."""

import datetime

import duckdb

from citelake.plans import roundtrip
from citelake.schemas import schema


def test_load_round_trip_of_dirty_rows(spark, tmp_path):
    """Repeats, children without an article, two kinds of author at one position, null keys and files in pieces."""
    day, file = (lambda n: datetime.datetime(2024, 1, n)), (lambda n: f"pubmed25n{n:04d}.xml.gz")
    article = [{"pmid": p, "source_file": file(f), "article_title": f"<T> & \"{p}\"", "nlm_catalog_id": "1", "issn_linking": "1-2", "date_revised": day(2).date(), "loaded_at": day(1)} for f in range(1, 31) for p in range(1, 3 + f % 4)]
    article += [{"pmid": p, "source_file": file(99), "article_title": "x", "nlm_catalog_id": "1", "volume": str(p), "loaded_at": day(1)} for p in range(1, 20)]
    article += [article[0] | {"article_title": "a longer one", "loaded_at": day(3)}, article[1] | {"article_title": " ", "loaded_at": day(3)}, article[2] | {"nlm_catalog_id": None}]
    at = [{"pmid": a["pmid"], "source_file": a["source_file"]} for a in article[:60]] + [{"pmid": 777, "source_file": file(1)}, {"pmid": 1, "source_file": file(500)}]
    tables = {
        "article": article, "abstract_text": [k | {"seq": i, "text": t, "label": "A&B"} for k in at for i, t in enumerate(("one  two", None, "three"))],
        "author": [k | {"position": i, "kind": kind, "name": n, "orcid": None, "valid": True} for k in at for i, kind, n in ((1, "collective", "Z"), (1, "author", "A"), (1, "author", "A"), (2, "collective", "G"), (3, "author", None))],
        "author_affiliation": [k | {"position": i, "affiliation": t} for k in at for i, t in ((1, "Lab"), (1, "Lab"), (2, "none"), (3, "<Unit>"), (4, "nobody"), (None, "nowhere"))],
        "mesh_qualifier": [k | {"descriptor_ui": "D1", "qualifier_ui": q, "qualifier_name": "use", "major_topic": q == "Q1"} for k in at for q in ("Q1", "Q1", None)],
        "deleted_pmid": [{"pmid": p, "source_file": file(f)} for p, f in ((1, 1), (1, 1), (None, 2), (5, 200), (None, 201))],
    }
    con = duckdb.connect()
    for name, rows in tables.items():
        of = schema(name)
        spark.createDataFrame([tuple(r.get(c) for c in of.names) for r in rows], of).write.parquet(f"{tmp_path}/{name}.parquet")
        con.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.sql(f"select table_name, source_file, n, n_chars from ({roundtrip.ORACLE['q36_load_round_trip']})").fetchall()
    for records in (4, roundtrip.RECORDS):
        got = roundtrip.q36_load_round_trip(spark, str(tmp_path), records).select("table_name", "source_file", "n", "n_chars").collect()
        assert sorted(map(tuple, got)) == sorted(want)
