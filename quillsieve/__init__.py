"""quillsieve: curation of instruction-tuning samples as Spark DataFrame jobs."""
