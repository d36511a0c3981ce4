"""Writers: JDBC, sorted cells, keyed serving table, Kafka frames."""
