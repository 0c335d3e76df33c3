"""Stream and offset analytics as composable Spark DataFrame transforms."""
