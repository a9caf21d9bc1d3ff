"""lumbre: a Spark-native engine for record extraction, reconciliation and export."""
