"""Entity deduplication over RDF-style person records, as Spark DataFrame plans."""
