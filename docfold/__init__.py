"""docfold: nested documents from normalized change rows, as Spark jobs."""
