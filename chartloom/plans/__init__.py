"""The datasets: each module maps stage names to functions of a catalog."""
