"""Compositions of operators: stand-in views of the test tables, the
parameterised reports, and the registered checks."""
