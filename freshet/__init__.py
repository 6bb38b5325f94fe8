"""freshet: flood-episode analytics and data preparation as composable Spark DataFrame operators."""
