"""General data-quality operators: dangling references and instants."""
