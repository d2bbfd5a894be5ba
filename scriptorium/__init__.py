"""Document-to-dataset engine on PySpark: sources, text functions, splitters, model stages and sinks as DataFrame plans."""
