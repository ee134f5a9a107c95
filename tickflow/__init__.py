"""tickflow: Spark-native operators and jobs for the event logs of a tick-based ledger."""
