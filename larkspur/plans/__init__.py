"""Complete jobs built from the operators: words, traffic, matching, movies."""
