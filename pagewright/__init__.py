"""Content analytics for scraped sites and chatbot transcripts, written as Spark DataFrame jobs."""
