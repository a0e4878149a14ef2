"""Clinical data-model transformation as lazy Spark plans."""
