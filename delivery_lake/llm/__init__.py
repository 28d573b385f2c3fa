"""Operators for preparing language-model training text.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds its queries when it is
present. Each module ``opN_*`` holds one operator with its own interface, ``queries`` the thin
registered queries, ``corpus_pipeline`` (top of the repository) chains five of them."""
