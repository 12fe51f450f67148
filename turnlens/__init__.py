"""turnlens: diagnosis of chatbot conversations on Spark."""
