"""DataFrame -> DataFrame operators: cleaning (B), enrichment (C), KPIs (D), profiling (E),
machine learning (F)."""
