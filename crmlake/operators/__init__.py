"""DataFrame operators: flatten, resolve, edges, history, merge, quality."""
