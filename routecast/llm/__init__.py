"""Operations for preparing training text: deduplication, filtering, scoring,
tokenising, packing, rendering and vector search, each as Spark jobs."""
