"""parcelmart: an order-data warehouse and late-delivery risk job, written as Spark DataFrame plans."""
