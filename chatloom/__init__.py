"""chatloom: fine-tuning data preparation as Spark DataFrame transformations.

Every operator is a function DataFrame -> DataFrame or Column -> Column. Plans
stay lazy: nothing here collects rows to the driver.
"""
