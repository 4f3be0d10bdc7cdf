from halocline.cli import main

main()
