"""articlelake: Spark jobs that prepare article corpora for SQL analytics and retrieval."""
