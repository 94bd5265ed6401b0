from tidemark import FEEDS
from tidemark.workload import layer_queries


def test_documents_are_read_as_far_as_the_feed_needs(spark, monkeypatch):
    """The schema is inferred from all of them; of the observation only its time is then read."""
    rows = spark.sql("""
        SELECT id AS event_id, id AS user_id, 'view' AS event_type, id * 0.5D AS v, CAST(id AS INT) AS k,
               CAST(1704110400 + id AS INT) AS s FROM range(1, 5)""")
    seen, run = [], layer_queries.run_raw_to_clean
    monkeypatch.setattr(layer_queries, "run_raw_to_clean", lambda raw, *args, **more: (seen.append(raw.schema), run(raw, *args, **more)))
    layers = layer_queries._Growing(spark, FEEDS["hourly"])
    layers.take(rows)
    assert seen[0]["current"].dataType.names == ["dt"]
    assert {"feels_like", "weather", "pressure"} <= set(seen[0]["hourly"].dataType.elementType.names)
    assert layers.rows(layers.clean).count() == 1 + 2 + 3 + 4
