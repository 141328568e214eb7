"""Sources: Kafka, file streams, literal rows, the lake table, documents."""
