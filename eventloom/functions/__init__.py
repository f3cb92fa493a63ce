"""Small column and frame helpers used by the operators."""
