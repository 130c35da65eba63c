"""Writers: partitioned lake, key-based merges, JDBC and Kafka."""
