"""changeloom: change-data-capture and corpus operators as plain PySpark DataFrame transformations."""
