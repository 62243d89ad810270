"""Pages of one input split are parsed in many tasks."""

from plumbline.sources import html_pages

PAGE = "<table><tr><th>Name</th></tr><tr><td>n{}</td></tr></table><p>x</p>"


def test_pages_of_one_split_are_parsed_apart(spark):
    pages = spark.createDataFrame([(i, PAGE.format(i)) for i in range(40)], "id long, html string")
    one = pages.coalesce(1)
    rows = html_pages.table_columns(html_pages.html_tables(one, "html", ["id"], 0), ["Name"], ["id"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows.rdd.getNumPartitions() == parts > 1
    assert sorted((r.id, r.row_no, r.Name) for r in rows.collect()) == [
        (i, 1, f"n{i}") for i in range(40)]
    fields = html_pages.html_class_fields(one, "html", ["id"], "table", None, [("n", "td", None)])
    assert fields.rdd.getNumPartitions() == parts
    assert html_pages.html_paragraphs(one, "html", ["id"]).rdd.getNumPartitions() == parts
