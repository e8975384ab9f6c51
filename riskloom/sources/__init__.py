"""Reading inputs, writing month-partitioned outputs, test-data snapshots."""
