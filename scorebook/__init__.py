"""Ball-by-ball cricket analytics as lazy PySpark DataFrame functions.

Builders take DataFrames and return DataFrames. They open no session, touch
no path and run no action; only ``scorebook.plans`` and the writers in
``scorebook.sources`` do.
"""
