"""The row-wise operators on growing folders."""
